"""Byte-level BPE ids of whole texts, with a cache of space-separated chunks.

A single space between two non-space characters always starts a new pre-token, and no pre-token
looks behind its start; so a text can be cut there and the ids of equal chunks reused. The ids are
those of ``tokenizers.Tokenizer.encode(text, add_special_tokens=False)`` (tested). Chunks without an
added token are encoded from the same merges by the ``tiktoken`` core, all new ones of a slice in
one call: joined by spaces they are cut at the same places again.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import numpy as np

#: A cut: one space with no white space beside it (Python's class holds all of the tokenizer's).
CUT = re.compile(r"(?<=\S) (?=\S)")
#: White space other than space and newline; without it, and without the pairs below, split(" ") cuts the same.
RARE_SPACE = re.compile(r"[\t\x0b-\x0d\x1c-\x1f\x85\xa0  -     　]")
#: Memory of the chunks kept in a worker, about; beyond that, and above this length, a chunk is encoded once a slice.
CACHE_BYTES, CACHE_CHARS = 40_000_000, 64
#: What an entry takes besides its characters and ids.
ENTRY_BYTES = 200


def chunks(text: str) -> list[str]:
    """The parts between cuts, without the space that belongs to each but the first."""
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or RARE_SPACE.search(text):
        return CUT.split(text)
    return text.split(" ")


def _holes(found: list) -> Iterator[int]:
    at = -1
    while True:
        try:
            at = found.index(None, at + 1)
        except ValueError:
            return
        yield at


class ChunkedBpe:
    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self._bytes[rank] = len(token)
        self._full = Tokenizer.from_file(tokenizer_path)
        self._added = [t.content for t in self._full.get_added_tokens_decoder().values()]
        self._cache: dict[str, bytes] = {}
        self._held = 0

    def _slow(self, text: str) -> bytes:
        return array("I", self._full.encode(text, add_special_tokens=False).ids).tobytes()

    def _fill(self, new: list[str], into: dict[str, bytes]) -> None:
        """Ids of ``" " + chunk`` for each distinct new chunk."""
        plain, joined = new, " " + " ".join(new)
        if any(t in joined for t in self._added):
            plain = [c for c in new if not any(t in c for t in self._added)]
            for chunk in set(new).difference(plain):
                into[chunk] = self._slow(" " + chunk)
            joined = " " + " ".join(plain)
        if not plain:
            return
        ids = np.asarray(self._fast.encode_to_numpy(joined, disallowed_special=()), np.uint32)
        ends = np.cumsum(self._bytes[ids])
        wanted = np.cumsum([len(c.encode()) + 1 for c in plain])
        stops = (np.searchsorted(ends, wanted) + 1) * 4
        raw, start = ids.tobytes(), 0
        for chunk, stop in zip(plain, stops.tolist(), strict=True):
            into[chunk] = raw[start:stop]
            start = stop

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [chunks(t) for t in texts]
        get = self._cache.get
        known = [list(map(get, parts[1:])) for parts in split]
        holes = [list(_holes(ids)) for ids in known]
        new = {parts[i + 1] for parts, at in zip(split, holes, strict=True) for i in at}
        local: dict[str, bytes] = {}
        self._fill(list(new), local)
        out = []
        for text, parts, ids, at in zip(texts, split, known, holes, strict=True):
            if any(" " in t and t in text for t in self._added):
                out.append(self._slow(text))
                continue
            for i in at:
                ids[i] = local[parts[i + 1]]
            out.append(self._slow(parts[0]) + b"".join(ids))
        for chunk, ids in local.items():
            if self._held >= CACHE_BYTES:
                break
            if len(chunk) <= CACHE_CHARS:
                self._cache[chunk] = ids
                self._held += ENTRY_BYTES + len(chunk) + len(ids)
        return out


_LOADED: dict[tuple, ChunkedBpe] = {}


def loaded(tokenizer_path: str, ranks_path: str, pattern: str) -> ChunkedBpe:
    """One encoder a worker process."""
    key = (tokenizer_path, ranks_path, pattern)
    if key not in _LOADED:
        _LOADED[key] = ChunkedBpe(*key)
    return _LOADED[key]
