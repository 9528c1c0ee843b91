"""Token ids of whole texts by a public tokenizer, at a cost that follows distinct pieces rather than text.

A text is cut where its tokenizer cuts whatever stands around: between ASCII letters, digits and marks, and at ASCII white
space. No token and no rule of the tokenizer reaches across such a cut, so each distinct piece is encoded once and
remembered. Where this can't be told from bytes (white space beyond ASCII beside a space counts for the byte-level
tokenizer) a text is one piece. The tokenizer's added tokens (such as <|endoftext|>) are one id wherever they are written;
a text that holds one is encoded whole."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from . import common as C

#: Kinds of bytes: white space, letters, digits, marks; an apostrophe and bytes beyond ASCII join what is beside them.
KIND = np.full(256, 3, np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = 0
KIND[[*range(65, 91), *range(97, 123)]] = 1
KIND[48:58] = 2
KIND[39], KIND[128:] = 5, 4
#: First bytes of white space beyond ASCII, and the separators below the space.
ODD = np.zeros(256, bool)
ODD[[0xC2, 0xE1, 0xE2, 0xE3, 0x1C, 0x1D, 0x1E, 0x1F]] = True

#: Pieces given to the library at once: its results are large beside the ids.
BATCH = 10_000


class Encoder:
    """path: a tokenizers file. drops_space: white space gives no tokens and case doesn't matter; else the space before a word belongs to it.
    Beyond `most` pieces or `most_ids` ids all are forgotten: pieces may be whole texts, so a number of pieces alone bounds nothing."""

    def __init__(self, path: str, drops_space: bool, most: int = 500_000, most_ids: int = 4_000_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.drops_space, self.most, self.most_ids = drops_space, most, most_ids
        self.forget()

    def forget(self) -> None:
        self.keys, self.begin, self.length, self.flat = np.zeros(0, C.U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def cut(self, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces begin, and their lengths."""
        kind = KIND[data]
        begins = np.zeros(len(data) + 1, bool)
        begins[rows] = True
        if len(data):
            here, before = kind[1:], kind[:-1]
            begins[1:-1] |= (here != before) & (here < 4) & (before < 4) & (here > 0) & (before > 0)
            if self.drops_space:
                begins[1:-1] |= (here == 0) != (before == 0)
            else:
                word = (here > 0) & (before == 0)
                word[rows[(rows > 0) & (rows < len(data))] - 1] = False
                begins[1:-1] |= word & (data[:-1] != 32) | (here == 0) & (before > 0)
                begins[:-2] |= word
                odd = np.flatnonzero(ODD[data])
                for r in np.unique(np.searchsorted(rows, odd, "right") - 1):
                    begins[rows[r] + 1 : rows[r + 1]] = False
                begins[rows] = True
        starts = np.flatnonzero(begins[:-1])
        lengths = np.diff(starts, append=len(data))
        if self.drops_space:
            solid = kind[starts] > 0
            starts, lengths = starts[solid], lengths[solid]
        return starts, lengths

    def holding(self, data: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Rows that hold an added token, ascending."""
        raw, found = data.tobytes(), set()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                r = int(np.searchsorted(rows, at, "right")) - 1
                inside = at + len(token) <= rows[r + 1]  # else it reaches into the next text
                if inside:
                    found.add(r)
                at = raw.find(token, int(rows[r + 1]) if inside else at + 1)
        return np.array(sorted(found), np.int64)

    def library(self, texts: list[str]) -> list[np.ndarray]:
        ids = []
        for k in range(0, len(texts), BATCH):
            ids += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts[k : k + BATCH], add_special_tokens=False)]
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids as unsigned 32-bit integers, and where each text's begin (and the end). A null text is empty."""
        data, rows = C.utf8(texts)
        starts, lengths = self.cut(data, rows)
        whole = self.holding(data, rows)
        if len(whole):
            own = self.library([data[rows[r] : rows[r + 1]].tobytes().decode("utf-8", "replace") for r in whole.tolist()])
            cached = ~np.isin(np.searchsorted(rows, starts, "right") - 1, whole)
            starts, lengths = starts[cached], lengths[cached]
        if self.drops_space:
            data = C.LOWER[data]
        keys, place = C.factorize(C.hash_slices(data, starts, lengths))
        if len(self.keys) > self.most or len(self.flat) > self.most_ids:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            one = np.zeros(len(keys), np.int64)
            one[place] = np.arange(len(place))
            new = np.flatnonzero(~known)
            raw = data.tobytes()
            pieces = [raw[starts[i] : starts[i] + lengths[i]].decode("utf-8", "replace") for i in one[new]]
            ids = self.library(pieces)
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            where = at[new]  # both are ascending: a merge, not a sort
            self.begin = np.insert(self.begin, where, len(self.flat) + np.cumsum(n) - n)
            self.length = np.insert(self.length, where, n)
            self.flat = np.concatenate([self.flat, *ids])
            self.keys = np.insert(self.keys, where, keys[new])
            at = np.searchsorted(self.keys, keys)
        n = self.length[at][place]
        ids = self.flat[C.ragged(self.begin[at][place], n)]
        ends = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=ends[1:])
        ends = ends[np.searchsorted(starts, rows)]
        if len(whole):
            more = np.zeros(len(ends), np.int64)
            more[whole + 1] = n = np.fromiter(map(len, own), np.int64, len(own))
            ids = np.insert(ids, np.repeat(ends[whole], n), np.concatenate(own))
            ends = ends + np.cumsum(more)
        return ids, ends


_held: dict = {}


def encoder(path: str, drops_space: bool) -> Encoder:
    """One for each Python worker, which serves many tasks."""
    key = (path, drops_space)
    if key not in _held:
        _held[key] = Encoder(path, drops_space)
    return _held[key]


def ending(ids: np.ndarray, rows: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """With an end id after each text."""
    return np.insert(ids, rows[1:], np.uint32(end_id)), rows + np.arange(len(rows))
