"""Chat formatting: schema fingerprints select declarative mappings to canonical turns.

A record is a JSON object. Its own nested field paths (``messages[].role``: every field it fills, two
levels deep, whatever the names) are read off it; those that some layout uses are sorted and hashed,
so that fields beside them (an id, a score) change nothing; the hash picks a layout from ``LAYOUTS``,
which says how its fields become turns (role, text). Turns are rendered with a template that marks them, and a loss mask gives the assistant's
texts as runs of code points. Control strings in texts and roles are escaped, so that no text can
open or close a turn of this or a like template, and ``read_back`` restores every turn.

DataFrame functions only. A conversation is one row and one task: its turns have to be put in order.
Defined cases: null texts and roles count as empty, and an empty field adds no blank line to those it is joined with; a text
that is itself JSON (an object, a list of objects, a number, ``null``) is a text like any other: what is a list is told by its
JSON type; a record of no known layout (a list with anything but objects in it among them), or one that is no JSON,
has null turns and a null rendering, and ``layout_counts`` counts it; a conversation's turns that tie are ordered by role, then text;
repeated turns are turns of their own, repeated records give a row each; an empty table gives no rows;
fields of no layout are ignored; very long texts are rendered whole; columns beside the record go along,
and one of a result's name among them raises ``reserved_column``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.errors import GridloomError
from gridloom.llm import common

OPEN, CLOSE, ASSISTANT = "<|turn|>", "<|end|>\n", "assistant"
#: Escapes in order; the escape character itself first (and last when reading back).
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\n"))

TURNS = "array<struct<role: string, text: string>>"

#: Layout: paths, then turns: ("role", fields joined by a blank line), or the list field, its role and text, and role names that change.
LAYOUTS: dict[str, tuple[tuple[str, ...], object]] = {
    "messages": (("messages[].content", "messages[].role"), ("messages", "role", "content", {})),
    "shared conversations": (("conversations[].from", "conversations[].value"), ("conversations", "from", "value", {"human": "user", "gpt": ASSISTANT})),
    "prompt and completion": (("completion", "prompt"), (("user", ("prompt",)), (ASSISTANT, ("completion",)))),
    "prompt and response": (("prompt", "response"), (("user", ("prompt",)), (ASSISTANT, ("response",)))),
    "system, prompt and response": (("prompt", "response", "system"), (("system", ("system",)), ("user", ("prompt",)), (ASSISTANT, ("response",)))),
    "preference": (("chosen", "prompt"), (("user", ("prompt",)), (ASSISTANT, ("chosen",)))),
    "instruction": (("instruction", "output"), (("user", ("instruction",)), (ASSISTANT, ("output",)))),
    "instruction and input": (("input", "instruction", "output"), (("user", ("instruction", "input")), (ASSISTANT, ("output",)))),
    "question and answer": (("answer", "question"), (("user", ("question",)), (ASSISTANT, ("answer",)))),
}
#: Columns that formatting adds.
ADDED = ("paths", "layout", "turns", "formatted", "loss_mask")
#: Every path that a layout uses, and the schema that its values are read with.
KNOWN = sorted({path for paths, _ in LAYOUTS.values() for path in paths})


def _schema() -> str:
    lists: dict[str, list[str]] = {}
    for path in KNOWN:
        name, _, part = path.partition("[].")
        lists.setdefault(name, []).extend([part] if part else [])
    return ", ".join(f"{n} array<struct<{', '.join(f'`{p}`: string' for p in parts)}>>" if parts else f"{n} string" for n, parts in lists.items())


RECORD = _schema()


def paths_of(record: Column) -> Column:
    """The nested paths that a JSON record fills, sorted: ``name``, or ``name[].part`` for fields of listed objects.

    The map of texts no longer tells a list from a text that looks like one; a path that steps into the record's own list does.
    """
    fields = F.map_entries(F.map_filter(F.from_json(record, "map<string, string>"), lambda _, v: v.isNotNull()))

    def of(field: Column) -> Column:
        inside = F.call_function("get_json_object", record, F.concat(F.lit("$['"), field["key"], F.lit("'][*]")))
        listed = F.when(field["value"].startswith("[") & inside.isNotNull(), F.from_json(field["value"], "array<map<string, string>>"))
        filled = F.flatten(F.transform(F.filter(listed, lambda m: m.isNotNull()), lambda m: F.map_keys(F.map_filter(m, lambda _, v: v.isNotNull()))))
        nested = F.transform(F.array_distinct(filled), lambda part: F.concat(field["key"], F.lit("[]."), part))
        return F.when(F.size(nested) > 0, nested).otherwise(F.array(field["key"]))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(fields, of))))


def fingerprint(paths: Column) -> Column:
    """Hash of a record's paths, as far as some layout uses them."""
    known = F.array(*[F.lit(p) for p in KNOWN])
    return F.xxhash64(F.array_join(F.array_sort(F.array_intersect(paths, known)), "\n"))


def _named(paths: tuple[str, ...]) -> Column:
    return F.xxhash64(F.lit("\n".join(sorted(paths))))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _list_turn(role: str, text: str, renamed: dict[str, str]):
    def one(x: Column) -> Column:
        named = x[role]
        for old, new in renamed.items():
            named = F.when(x[role] == old, new).otherwise(named)
        return _turn(named, x[text])

    return one


def canonical_turns(record: Column, found: Column) -> Column:
    """Turns of a parsed record by the layout whose path hash is ``found``; null for none."""
    turns = F.lit(None).cast(TURNS)
    for paths, how in LAYOUTS.values():
        if isinstance(how[0], str):
            made = F.transform(record[how[0]], _list_turn(*how[1:]))
        else:
            made = F.array(*[_turn(F.lit(role), F.concat_ws("\n\n", *[F.nullif(record[f], F.lit("")) for f in fields])) for role, fields in how])
        turns = F.when(found == _named(paths), made).otherwise(turns)
    return turns


def _replaced(text: Column, pairs: tuple) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escaped(text: Column, pairs: tuple = ESCAPES) -> Column:
    return _replaced(text, pairs)


def unescaped(text: Column, pairs: tuple = ESCAPES) -> Column:
    """Inverse of :func:`escaped`: each backslash begins one escape, the backslash's own is read last."""
    return _replaced(text, tuple((new, old) for old, new in reversed(pairs)))


def formatted(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), escaped(t["role"], ROLE_ESCAPES), F.lit("\n"), escaped(t["text"]), F.lit(CLOSE))), "")


def loss_mask(turns: Column) -> Column:
    """Runs (code points, under the loss or not) that cover the rendering in order: three a turn."""

    def runs(t: Column) -> Column:
        head = F.length(escaped(t["role"], ROLE_ESCAPES)) + len(OPEN) + 1
        run = lambda n, loss: F.struct(n.cast("long").alias("chars"), loss.alias("loss"))
        return F.array(run(head, F.lit(False)), run(F.length(escaped(t["text"])), t["role"] == ASSISTANT), run(F.lit(len(CLOSE)), F.lit(False)))

    return F.flatten(F.transform(turns, runs))


def read_back(text: Column) -> Column:
    """The turns of a rendering."""
    pieces = F.split(F.regexp_replace(text, r"<\|end\|>\n$", ""), r"<\|end\|>\n")

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(OPEN) + 1))
        cut = F.instr(body, "\n")
        return F.struct(unescaped(F.substr(body, F.lit(1), cut - 1), ROLE_ESCAPES).alias("role"), unescaped(F.substr(body, cut + 1)).alias("text"))

    return F.when(text == "", F.array().cast(TURNS)).otherwise(F.transform(pieces, turn))


def under_mask(text: Column, mask: Column) -> Column:
    """The text of the masked runs of a rendering, unescaped, nothing between."""
    start = F.struct(F.lit(1).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(so_far: Column, run: Column) -> Column:
        part = F.array(F.substr(text, so_far["at"].cast("int"), run["chars"].cast("int")))
        return F.struct((so_far["at"] + run["chars"]).alias("at"), F.when(run["loss"], F.concat(so_far["parts"], part)).otherwise(so_far["parts"]).alias("parts"))

    return F.aggregate(mask, start, step, lambda x: F.array_join(F.transform(x["parts"], lambda t: unescaped(t)), ""))


def format_records(records: DataFrame, record: str = "record") -> DataFrame:
    """The rows of ``records`` (key and JSON ``record``) with paths, layout, turns, formatted and loss_mask."""
    if {c.lower() for c in records.columns if c != record} & set(ADDED):
        raise GridloomError("reserved_column")
    keys = [records[c] for c in records.columns if c != record]
    parsed, print_ = common.fresh_names(records, "parsed", "fingerprint")
    named = records.select(*keys, F.from_json(records[record], RECORD).alias(parsed), paths_of(records[record]).alias("paths"))
    named = named.withColumn(print_, fingerprint(F.col("paths")))
    layout = F.lit(None).cast("string")
    for name, (paths, _) in LAYOUTS.items():
        layout = F.when(F.col(print_) == _named(paths), name).otherwise(layout)
    turned = named.withColumns({"layout": layout, "turns": canonical_turns(F.col(parsed), F.col(print_))}).drop(parsed, print_)
    return turned.withColumns({"formatted": formatted(F.col("turns")), "loss_mask": loss_mask(F.col("turns"))})


def layout_counts(made: DataFrame) -> DataFrame:
    """layout (null: none fits), paths (of those without a layout) and records: what formatting made of a table."""
    return made.groupBy("layout", F.when(F.col("layout").isNull(), F.col("paths")).alias("paths")).agg(F.count("*").alias("records"))


def conversation_turns(rows: DataFrame) -> DataFrame:
    """conv_id and messages (role, content), in order, of a table with a row a turn."""
    turn = F.struct(rows["turn"].cast("long").alias("turn"), F.coalesce(rows["role"].cast("string"), F.lit("")).alias("role"), F.coalesce(rows["text"].cast("string"), F.lit("")).alias("content"))
    messages = F.transform(F.sort_array(F.collect_list("m")), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return rows.select(rows["conv_id"].cast("long").alias("conv_id"), turn.alias("m")).groupBy("conv_id").agg(messages.alias("messages"))


def conversation_records(rows: DataFrame) -> DataFrame:
    """conv_id and record (message layout) of a table with a row a turn."""
    return conversation_turns(rows).select("conv_id", F.to_json(F.struct("messages")).alias("record"))


def mixed_records(rows: DataFrame) -> DataFrame:
    """conv_id and record, in as many layouts as the conversations allow: what heterogeneous sources deliver.

    Question and answer, with or without a system text, come as flat fields of several names; others as
    lists of messages or, where no role has a name that is translated, of shared conversations.
    """
    m, kind = F.col("messages"), F.pmod(F.col("conv_id"), F.lit(4))
    roles, content = F.transform(m, lambda x: x["role"]), lambda i: m[i]["content"]
    are = lambda *names: roles == F.array(*[F.lit(n) for n in names])
    flat = lambda **fields: F.to_json(F.struct(F.col("conv_id").alias("id"), *[c.alias(n) for n, c in fields.items()]))
    pair = [("prompt", "completion"), ("prompt", "response"), ("question", "answer"), ("instruction", "output")]
    shared = F.transform(m, lambda x: F.struct(F.when(x["role"] == "user", "human").when(x["role"] == ASSISTANT, "gpt").otherwise(x["role"]).alias("from"), x["content"].alias("value")))
    record = F.when(are("system", "user", ASSISTANT), flat(system=content(0), prompt=content(1), response=content(2)))
    for k, (asked, answered) in enumerate(pair):
        record = record.when(are("user", ASSISTANT) & (kind == k), flat(**{asked: content(0), answered: content(1)}))
    record = record.when((kind % 2 == 1) & ~F.arrays_overlap(roles, F.array(F.lit("human"), F.lit("gpt"))), flat(conversations=shared))
    return conversation_turns(rows).select("conv_id", record.otherwise(flat(messages=m)).alias("record"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = common.documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(probe).alias("text"))
    made = format_records(mixed_records(table.unionByName(extra)))
    turns, loss = read_back(F.col("formatted")), under_mask(F.col("formatted"), F.col("loss_mask"))
    read = made.select("conv_id", turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"), "layout")
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "layout",
    )


ORACLE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') r, coalesce(text, '') t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (SELECT *, length(r) + length(regexp_replace(r, '[^\\<\[\n]', '', 'g')) + length(t) + length(regexp_replace(t, '[^\\<\[]', '', 'g')) + 17 n FROM rows)
SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, CASE
  WHEN n_turns = 3 AND roles = 'system' || chr(10) || 'user' || chr(10) || 'assistant' THEN 'system, prompt and response'
  WHEN n_turns = 2 AND roles = 'user' || chr(10) || 'assistant' THEN ['prompt and completion', 'prompt and response', 'question and answer', 'instruction'][1 + (conv_id % 4 + 4) % 4]
  WHEN conv_id % 2 <> 0 AND translated = 0 THEN 'shared conversations' ELSE 'messages' END layout
FROM (SELECT conv_id, count(*)::BIGINT n_turns, count(*) FILTER (WHERE r IN ('human', 'gpt')) translated, string_agg(r, chr(10) ORDER BY turn, r, t) roles, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) turns_sha256,
  coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0)::BIGINT loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (WHERE r = 'assistant'), '')) loss_sha256, sum(n)::BIGINT formatted_chars
FROM sized GROUP BY conv_id)
"""
