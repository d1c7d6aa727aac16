"""Token counts: prefix dynamic programming gives the exact token count at every prefix of a text."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthframe.llm.common import arrow_map
from growthframe.llm.pieces import SPACE, TAIL, Vocabulary, units

#: Units whose counts a task remembers; the memory is then begun anew, which changes time only.
REMEMBERED = 800_000


class PrefixCounter:
    """Token counts at every prefix.

    The tokens of a text's prefix are those of a shorter prefix and one last piece, and the piece that fits is
    the one that stays apart from the last piece of that shorter prefix. So the table of a text holds, for each
    prefix, its last piece and its count; a longer text with the same beginning continues that table."""

    def __init__(self, path: str | None = None):
        self.v = Vocabulary(path)
        self.totals: dict[str, int] = {}
        self._parts: dict[str, int] = {}
        self._last: list[int] = [-1]
        self._count: list[int] = [0]
        self._text = ""

    def _segment(self, text: str) -> list[int]:
        """Counts at the prefixes of a text inside which every two neighbours may merge."""
        v = self.v
        ids, apart, size, tails, lengths = v.ids, v.apart, v.size, v._lengths, v.lengths
        old = self._text
        same, most = 0, min(len(text), len(old))
        if text[:most] == old[:most]:
            same = most
        else:
            while text[same] == old[same]:
                same += 1
        last, count = self._last, self._count
        del last[same + 1:], count[same + 1:]
        for end in range(same + 1, len(text) + 1):
            tail = text[max(0, end - TAIL):end]
            for n in tails.get(tail) or lengths(tail):
                if n <= end:
                    start = end - n
                    piece = ids.get(text[start:end])
                    if piece is not None:
                        if start:
                            before = last[start]
                            fit = apart.get(before * size + piece)
                            if fit is None:
                                fit = v.stay_apart(before, piece)
                            if not fit:
                                continue
                        last.append(piece)
                        count.append(count[start] + 1)
                        break
            else:
                raise ValueError(f"no piece ends {text[:end]!r}")
        self._text = text
        return count[1:]

    def _total(self, unit: str) -> int:
        if unit[:2] == SPACE * 2 or unit == SPACE:
            return self.prefixes(unit)[-1]
        total, parts = 0, self._parts
        for part in self.v.segments(unit):
            n = parts.get(part)
            if n is None:
                n = parts[part] = self._segment(part)[-1] if part[0] in self.v.ids else len(part.encode())
            total += n
        return total

    def prefixes(self, unit: str) -> list[int]:
        """Count of tokens at each prefix of a unit, in characters."""
        v, out, total = self.v, [], 0
        run = len(unit) - len(unit.lstrip(SPACE))
        if run == len(unit):
            return [len(v.blanks(k)) for k in range(1, run + 1)]
        if run > 1:  # the marks before the last one merge among themselves, with the last one if the word leaves it
            out = [len(v.blanks(k)) for k in range(1, run)]
            for k, n in enumerate(self.prefixes(unit[run - 1:]), run):
                alone = k > run and self._alone(unit[run - 1:k])
                out.append(len(v.blanks(run)) + n - 1 if alone or k == run else out[run - 2] + n)
            return out
        for part in v.segments(unit):
            if part[0] not in v.ids:
                out.append(total := total + len(part[0].encode()))
            else:
                out += [total + n for n in self._segment(part)]
                total = out[-1]
        return out

    def _alone(self, unit: str) -> bool:
        """Whether the first token of a unit with one space mark is that mark."""
        head = self.v.segments(unit)[0]
        if len(head) == 1:
            return True
        self._segment(head)
        at = len(head)
        while at > 0:
            size = len(self.v.text[self._last[at]])
            if at == size:
                return size == 1
            at -= size
        return False

    def unit_totals(self, found: list[str]) -> list[int]:
        new = sorted(set(found).difference(self.totals))
        if len(self.totals) + len(new) > REMEMBERED:
            self.totals.clear()
            new = sorted(set(found))
            self._parts.clear()
        for unit in new:  # sorted: a unit continues the table of the one before
            self.totals[unit] = self._total(unit)
        return [*map(self.totals.__getitem__, found)]

    def count(self, text: str) -> int:
        return sum(self.unit_totals(units(text)))

    def at_prefixes(self, text: str) -> list[int]:
        """Exact token count of ``text[:k]`` for every k from 0."""
        out, total = [0], 0
        for unit in units(text):
            out += [total + n for n in self.prefixes(unit)]
            total = out[-1]
        return [0, *out[2:]] if text else out  # the mark put in front is no character of the text

    def fits(self, text: str, budget: int) -> int:
        """Length of the longest prefix with at most ``budget`` tokens, from the counts alone."""
        found = units(text)
        sums = list(accumulate(self.unit_totals(found)))
        if not sums or sums[-1] <= budget:
            return len(text)
        k = next(i for i, s in enumerate(sums) if s > budget)
        before, length = (sums[k - 1] if k else 0), sum(map(len, found[:k]))
        inside = max((i for i, n in enumerate(self.prefixes(found[k]), 1) if before + n <= budget), default=0)
        return max(0, length + inside - 1)


def _measured(docs: DataFrame, text_col: str, path: str | None, budget: int) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(path)
        for batch in batches:
            rows, sizes, counts, fits = batch.column(0), [], [], []
            for k in range(0, batch.num_rows, 500):
                texts = [t or "" for t in batch.column(1).slice(k, 500).to_pylist()]
                each = [*map(units, texts)]
                totals = counter.unit_totals([u for us in each for u in us])
                at = 0
                for text, us in zip(texts, each):
                    n = sum(totals[at:at + len(us)])
                    at += len(us)
                    sizes.append(len(text.encode("utf-8", "replace")))
                    counts.append(n)
                    fits.append(len(text) if n <= budget else counter.fits(text, budget))
            new = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (sizes, counts, fits)], ["n_bytes", "n_tokens", "fit_chars"])
            yield pa.record_batch([rows, new], names=["row", "tokens"])

    kept = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return arrow_map(kept, of, f"row {docs.schema.simpleString()}, tokens struct<n_bytes: bigint, n_tokens: bigint, fit_chars: bigint>")


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = 4096) -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens`` of the whole text, ``over_limit`` (more than ``limit``),
    ``fit_chars`` (length of the longest prefix with at most ``limit`` tokens).

    Tokens are those of the model at ``path``, without begin, end or special tokens. A NULL or empty
    text has none. Repeated rows give repeated results; NULL ids stay; an empty table gives an empty one."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = _measured(slim, "text", path, limit)
    return out.select(F.col("row.id").alias(id_col), "tokens.n_bytes", "tokens.n_tokens", (F.col("tokens.n_tokens") > limit).alias("over_limit"), "tokens.fit_chars")


def truncate(docs: DataFrame, budget: int, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with each text cut to its longest prefix of at most ``budget`` tokens; NULL stays NULL."""
    out = _measured(docs, text_col, path, budget)
    cut = F.when(F.col("row")[text_col].isNotNull(), F.expr(f"left(row.`{text_col}`, cast(tokens.fit_chars AS int))"))
    return out.select(*[(cut if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
