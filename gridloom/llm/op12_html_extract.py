"""Main text of HTML pages by two passes over their blocks.

The first pass decides each block by itself. Parts that are never article text (navigation, page headers and footers,
sidebars, notices, adverts, forms, reader comments, by element, role or name) and blocks mostly of links are
boilerplate; so is all outside the article of a page that marks one. Of the rest, blocks of some length with the share
of stop words that prose has are text. What is short, or long without stop words (lists, code, languages whose stop words
are not known), stays open. In the second pass an open block takes the label of its nearest decided neighbours: of both
if they agree, else of the nearer, and a heading that of the block below it. Beyond the first and the last block lies text in
a marked article, boilerplate elsewhere; a page without any decided text keeps its open blocks. A heading such as
"Comments (3)" begins the readers' comments, which go on to the end.

A page is one row and worked out by itself: no shuffle, and a lost task is run again.

Defined cases: a null html counts as empty; pages without article text give an empty text; null keys and repeated rows are
kept, a row each; very long pages are read whole, one at a time; an empty table gives no rows; other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import common
from gridloom.llm.html_blocks import OUTSIDE, Block, blocks

#: Frequent words of some languages; a block's share of them tells prose from labels.
STOP_WORDS = frozenset(
    "the of and to in is that it was for on are with as be this have from or by not but which at an they were had we you can all there their "
    "der die das und ist nicht ein eine den von zu mit sich auf für dem im auch des als es wird bei oder sind nach wie "
    "de la le et les des un une du que qui dans pour est sur pas au plus par avec ce il sont "
    "el los las y en una por con para del se su al lo como más o pero sus "
    "di che non è della per il sono da si anche i a e os um uma não na no do "
    "het een van niet dat op te zijn".split()
)
WORD = re.compile(r"[^\W\d_]+")
#: Below these code points a block is too short to be decided by its words.
SHORT_CHARS = 70
#: Share of stop words from which a block of that length is text.
STOP_SHARE = 0.2
#: Share of a block's code points in links from which it is boilerplate.
LINK_SHARE = 0.4
NOTICE = re.compile(r"©|\(c\) ?\d{4}|all rights reserved|\bcookies?\b", re.I)
COMMENTS = re.compile(r"(?:\d+ )?(?:reader |user |leser)?(?:comments?|responses|replies|kommentare?|commentaires?|comentarios?|commenti)(?: ?\(?\d+\)?)?:?", re.I)

TEXT, BOILERPLATE, OPEN = 1, 0, None
SCHEMA = "page_id long, url string, text string"


def first_pass(block: Block, least_region: int) -> int | None:
    """The label of a block by itself, or None where that leaves it open."""
    if block.apart or block.region < least_region:
        return BOILERPLATE
    marked, chars = block.region > OUTSIDE, len(block.text)
    if block.link_chars > LINK_SHARE * chars:
        return OPEN if marked and block.heading else BOILERPLATE
    if chars < SHORT_CHARS:
        return OPEN if marked or not block.link_chars and not NOTICE.search(block.text) else BOILERPLATE
    words = [w.lower() for w in WORD.findall(block.text)]
    dense = sum(w in STOP_WORDS for w in words) >= STOP_SHARE * max(len(words), 1)
    if not marked and chars < 4 * SHORT_CHARS and NOTICE.search(block.text):
        return BOILERPLATE
    return TEXT if dense and not block.heading else OPEN


def second_pass(labels: list[int | None], headings: list[bool], edge: int) -> list[int]:
    """Labels with the open ones settled by their nearest decided neighbours; ``edge`` lies beyond both ends and settles ties."""

    def decided(order: range, start: int) -> list[tuple]:
        """For each block, the last decided label before it in this order, and its place."""
        at, last = [(edge, start)] * len(labels), (edge, start)
        for i in order:
            last = last if labels[i] is OPEN else (labels[i], i)
            at[i] = last
        return at

    places = range(len(labels))
    above, below, settled = decided(places, -1), decided(places[::-1], len(labels)), []
    for i in places:
        (up, up_at), (down, down_at) = above[i], below[i]
        nearer = up if i - up_at < down_at - i else down if i - up_at > down_at - i else edge
        settled.append(down if up == down or headings[i] else nearer)
    return settled


def chosen(found: list[Block]) -> list[Block]:
    """The blocks that are the page's main text."""
    own = [b for b in found if b.region > OUTSIDE and not b.apart]
    own = [b for b in own if not b.doubtful] or own
    least = max((b.region for b in own), default=OUTSIDE)
    if least:
        # what stands apart within a marked article is no neighbour of its blocks
        found = [b for b in own if b.region == least]
    labels = [first_pass(b, least) for b in found]
    readers = next((i for i, b in enumerate(found) if b.heading and TEXT in labels[:i] and COMMENTS.fullmatch(b.text)), len(found))
    labels[readers:] = [BOILERPLATE] * (len(found) - readers)
    if not least and TEXT not in labels:
        return [b for b, label in zip(found, labels, strict=True) if label is OPEN]
    settled = second_pass(labels, [b.heading for b in found], TEXT if least else BOILERPLATE)
    return [b for b, label in zip(found, settled, strict=True) if label == TEXT]


def main_text(html: str | None) -> str:
    return "\n\n".join(b.text for b in chosen(blocks(html or "")))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every page."""

    def work(part: pa.RecordBatch) -> dict:
        return {"page_id": part.column(0), "url": part.column(1), "text": [main_text(h) for h in part.column(2).to_pylist()]}

    return common.map_slices(pages.select(*[pages[c].cast(t).alias(c) for c, t in (("page_id", "long"), ("url", "string"), ("html", "string"))]), work, SCHEMA, "html")


def op12_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.documents(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


#: For pages whose article is marked, with headings, paragraphs and a few character references, as those of the test tables.
ORACLE_SQL = r"""
WITH cut AS (SELECT page_id, url, list_filter(list_transform(regexp_split_to_array(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?(?:p|h[1-6]|div|ul|li)>'),
  lambda b: trim(regexp_replace(regexp_replace(replace(replace(regexp_replace(replace(b, '<br>', ' '), '<[^>]*>', '', 'g'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda b: b <> '') k FROM pages)
SELECT page_id, url, coalesce(array_to_string(k, chr(10) || chr(10)), '') AS text, length(coalesce(array_to_string(k, chr(10) || chr(10)), ''))::BIGINT n_chars FROM cut
"""
