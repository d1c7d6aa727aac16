"""Piece encoding and decoding: a suffix array of the batch text finds every piece, relaxation picks the path."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthframe.llm.common import arrow_map
from growthframe.llm.pieces import SPACE, Vocabulary, units

#: Units whose pieces a task remembers, and characters that are indexed at a time.
REMEMBERED = 800_000
INDEXED = 1 << 19


class Codec:
    def __init__(self, path: str | None = None):
        v = self.v = Vocabulary(path)
        chars = sorted({c for p in v.ids for c in p})
        self._code = {c: k for k, c in enumerate(chars, 1)}
        self._codes = np.zeros(0x110000, np.uint16)  # the line end, which is in no piece, separates segments: 0
        self._codes[[*map(ord, chars)]] = np.arange(1, len(chars) + 1)
        self._width = 2 * v.longest
        joined, at, low = self._spelled("\n".join(v.ids)).tobytes(), 0, []
        for p, i in v.ids.items():
            low.append((joined[at:at + 2 * len(p)], i))
            at += 2 * len(p) + 2
        low.sort()
        self._low = np.array([x for x, _ in low], f"S{self._width}")
        self._high = np.array([x.ljust(self._width, b"\xff") for x, _ in low], f"S{self._width}")
        self._piece = np.array([i for _, i in low], np.int64)
        self._chars = np.array([len(x) // 2 for x, _ in low], np.int64)
        self._known: dict[str, bytes] = {}
        self._pairs, self._apart = np.array([-1]), np.array([True])
        self._bytes = [b""] * v.size
        for i, p in v.text.items():
            self._bytes[i] = p.replace(SPACE, " ").encode()
        for i, b in v.byte_of.items():
            self._bytes[i] = bytes((b,))

    def _spelled(self, text: str) -> np.ndarray:
        """Two bytes a character, none of them 0 (fixed-width byte strings drop those at the end) or 255."""
        codes = self._codes[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        return np.stack([1 + codes // 254, 1 + codes % 254], 1).astype(np.uint8).reshape(-1)

    # Encoding -----------------------------------------------------------------------------------

    def _edges(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where each segment starts in the joined text, and every occurrence of every piece: start, end, piece."""
        padded = self._spelled("\n".join(segments) + "\n" * (1 + self.v.longest))
        n = len(padded) // 2 - self.v.longest
        rows = np.lib.stride_tricks.sliding_window_view(padded, self._width)[:2 * n:2]
        suffixes = np.ascontiguousarray(rows).view(f"S{self._width}").reshape(-1)
        array = np.argsort(suffixes, kind="stable")  # the suffix array, as deep as the longest piece
        ordered = suffixes[array]
        first, past = np.searchsorted(ordered, self._low, "left"), np.searchsorted(ordered, self._high, "right")
        count = past - first
        which = np.repeat(np.arange(len(count)), count)
        start = array[np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + first[which]]
        begins = np.concatenate([[0], np.cumsum([len(s) + 1 for s in segments])])
        return begins, start, start + self._chars[which], self._piece[which]

    def _fit(self, last: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each piece stays apart from the one before it (-1: none before)."""
        size = self.v.size
        keys = np.where(last < 0, -1, last * size + piece)
        at = np.minimum(np.searchsorted(self._pairs, keys), len(self._pairs) - 1)
        new = np.unique(keys[self._pairs[at] != keys])
        if len(new):
            fit = [self.v.stay_apart(k // size, k % size) for k in new.tolist()]
            into = np.searchsorted(self._pairs, new)
            self._pairs, self._apart = np.insert(self._pairs, into, new), np.insert(self._apart, into, fit)
            at = np.searchsorted(self._pairs, keys)
        return self._apart[at]

    def _relax(self, segments: list[str]) -> list[bytes]:
        """Ids (two bytes each) of each segment: edges by the place where they end, nodes left to right."""
        begins, start, end, piece = self._edges(segments)
        lengths = np.diff(begins) - 1
        depth = end - begins[np.searchsorted(begins, start, "right") - 1]
        by_place = np.argsort(depth.astype(np.uint16) if lengths.max() < 1 << 16 else depth, kind="stable")
        start, end, piece, depth = start[by_place], end[by_place], piece[by_place], depth[by_place]
        last, before = np.full(begins[-1] + 1, -1, np.int64), np.full(begins[-1] + 1, -1, np.int64)
        edge = np.searchsorted(depth, np.arange(1, lengths.max() + 2))
        for a, b in zip(edge, edge[1:]):  # all segments at once, one character further each time
            ok = np.flatnonzero(self._fit(last[start[a:b]], piece[a:b])) + a
            last[end[ok]], before[end[ok]] = piece[ok], start[ok]
        node, live = begins[:-1] + lengths, np.arange(len(segments))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(live):
            found.append((live, last[node]))
            node = before[node]
            more = node > begins[live]
            node, live = node[more], live[more]
        whose, ids = (np.concatenate(x) for x in zip(*reversed(found)))
        order = np.argsort(whose, kind="stable")
        ids, cuts = ids[order].astype("<u2").tobytes(), 2 * np.searchsorted(whose[order], np.arange(len(segments) + 1))
        return [ids[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]

    def _learn(self, new: list[str]) -> None:
        """Remember the ids of new units."""
        v = self.v
        cut = {}
        for u in new:
            if u[:2] == SPACE * 2 or u == SPACE:
                run = len(u) - len(u.lstrip(SPACE))
                cut[u] = v.segments(u[run - 1:]) if run < len(u) else []
            else:
                cut[u] = v.segments(u)
        todo = sorted({s for parts in cut.values() for s in parts if s[0] in self._code})
        ids: dict[str, bytes] = {}
        at = 0
        while at < len(todo):
            to, size = at, 0
            while to < len(todo) and (to == at or size + len(todo[to]) < INDEXED):
                size += len(todo[to])
                to += 1
            ids.update(zip(todo[at:to], self._relax(todo[at:to])))
            at = to
        pack = lambda x: np.array(x, "<u2").tobytes()
        for u, parts in cut.items():
            out = b"".join([ids[s] if s in ids else pack([v.byte[b] for b in s.encode()]) for s in parts])
            if u[:2] == SPACE * 2 or u == SPACE:
                run = len(u) - len(u.lstrip(SPACE))
                if run == len(u):
                    out = pack(v.blanks(run))
                elif out[:2] == pack([v.ids[SPACE]]):  # the word leaves the last mark to the others
                    out = pack(v.blanks(run)) + out[2:]
                else:
                    out = pack(v.blanks(run - 1)) + out
            self._known[u] = out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as the model's own library gives them."""
        each = [*map(units, texts)]
        met = {u for us in each for u in us}
        new = met.difference(self._known)
        if len(self._known) + len(new) > REMEMBERED:
            self._known.clear()
            new = met
        if new:
            self._learn(sorted(new))
        known = self._known.__getitem__
        return [np.frombuffer(b"".join(map(known, us)), "<u2") for us in each]

    # Decoding -----------------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, in UTF-8: without the space that encoding puts in front."""
        text = b"".join(map(self._bytes.__getitem__, ids.tolist()))
        return text[1:] if text[:1] == b" " else text


def _encoded(docs: DataFrame, text_col: str, path: str | None, schema: str) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for whole in batches:
            for k in range(0, whole.num_rows, 2000):
                batch = whole.slice(k, 2000)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                ids = codec.encode(texts)
                same = [codec.decode(x) == t.encode("utf-8", "replace") for x, t in zip(ids, texts)]
                ends = np.cumsum([0, *map(len, ids)])
                values = np.concatenate([np.zeros(0, "<u2"), *ids]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
                new = pa.StructArray.from_arrays([lists, pa.array(np.diff(ends), pa.int64()), pa.array(same, pa.bool_())], ["ids", "n_tokens", "round_trip"])
                yield pa.record_batch([batch.column(0), new], names=["row", "tokens"])

    kept = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return arrow_map(kept, of, f"row {schema}, tokens struct<ids: array<int>, n_tokens: bigint, round_trip: boolean>")


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``round_trip`` in place of ``text_col`` (and of columns of these names).

    ``ids`` are those of the model's own library for the whole text: no begin, end or special tokens, a
    special token's string in a text is ordinary text. ``round_trip`` says that decoding gave the text back:
    false where it holds a literal space mark, which decodes as a space, as in the library. A NULL or empty text has no ids. Repeated rows
    give repeated results; an empty table gives an empty one."""
    out = _encoded(docs, text_col, path, docs.schema.simpleString())
    new = ("ids", "n_tokens", "round_trip")
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != text_col and c not in new], "tokens.*")


def decode(tokens: DataFrame, ids_col: str = "ids", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``tokens`` with the text of ``ids_col`` as ``text_col``; NULL ids give NULL."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            lists = batch.column(1)
            flat, ends, null = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy(), lists.is_null().to_numpy(False)
            texts = [None if null[k] else codec.decode(flat[ends[k]:ends[k + 1]]).decode("utf-8", "replace") for k in range(batch.num_rows)]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    kept = tokens.select(F.struct(*[c for c in tokens.columns if c != text_col]).alias("row"), F.col(ids_col).alias("ids"))
    return arrow_map(kept, of, f"row {kept.schema['row'].dataType.simpleString()}, text string").select("row.*", F.col("text").alias(text_col))
