"""Token counts by prefix dynamic programming (operator 7)."""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import SIMPLE, SPACED, byte_letters, checked

LIMIT = 1024
#: Characters of units and pre-tokens, and pairs of tokens, that a worker remembers at most; then each store starts anew.
KEPT_CHARS, KEPT_PAIRS = 16_000_000, 500_000
#: Units are a run of white space (Unicode's, as the pre-tokenizer has it) and the run of other characters behind it.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNITS = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+").findall
LEADING = re.compile(f"[{_SPACE}]*").match
#: Pre-tokens of which a part is two: the mark and the letter.
SHORTENED = ("'re", "'ve", "'ll")


class PrefixTable:
    """Exact token counts of every prefix, by dynamic programming over the bytes of a pre-token.

    The tokens of a prefix are those of a shorter one and one token more: of the vocabulary's tokens that end here, the
    one that can follow the shorter prefix's last token, that is, the two encode to themselves. So only pairs of tokens
    are ever given to the library, once each; no text is encoded, and a pre-token takes time linear in its bytes.
    """

    def __init__(self, path: str):
        self.library = checked(path, True)
        self.model = self.library.model
        self.letters = byte_letters()
        back = {c: b for b, c in self.letters.items()}
        self.special = [str(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.split_special = re.compile("|".join(map(re.escape, self.special))).finditer
        special = set(self.special)
        self.vocabulary = {bytes([back[c] for c in t]): i for t, i in self.library.get_vocab(with_added_tokens=True).items() if t not in special}
        #: Finds all tokens that end at each byte (as a latin-1 character).
        self.ending = ahocorasick.Automaton()
        for t, i in self.vocabulary.items():
            self.ending.add_word(t.decode("latin-1"), (len(t), i))
        self.ending.make_automaton()
        self.named = {i: t for t, i in self.vocabulary.items()}
        self.wide = max(self.named) + 2
        self.fits: dict[int, bool] = {}
        self.parts: dict[str, bytes] = {}
        self.totals: dict[str, int] = {}
        self.kept = [0, 0]

    def follows(self, last: int, token: int) -> bool:
        """Whether two tokens, -1 for none, encode to themselves."""
        if len(self.fits) > KEPT_PAIRS:
            self.fits.clear()
        data = self.named[token] if last < 0 else self.named[last] + self.named[token]
        coded = self.model.tokenize(data.decode("latin-1").translate(self.letters))
        found = self.fits[(last + 1) * self.wide + token] = [t.id for t in coded] == ([token] if last < 0 else [last, token])
        return found

    def part(self, pretoken: str) -> bytes | list[int]:
        """Counts after each byte of a pre-token."""
        counts = self.parts.get(pretoken)
        if counts is not None:
            return counts
        data = pretoken.encode().decode("latin-1")
        fits, follows, wide = self.fits, self.follows, self.wide
        counts, last, here = [0], [-1], 0
        for end, (size, token) in self.ending.iter(data):
            if end < here:  # this place has its token
                continue
            before = last[end + 1 - size]
            fit = fits.get((before + 1) * wide + token)
            if fit or (fit is None and follows(before, token)):
                counts.append(counts[end + 1 - size] + 1)
                last.append(token)
                here += 1
        if here < len(data):
            raise ValueError("no token follows")
        if len(pretoken) <= 64 and len(data) < 256:
            counts = bytes(counts)
            self._keep(0, self.parts, pretoken)
            self.parts[pretoken] = counts
        return counts

    def _keep(self, which: int, store: dict, key: str) -> None:
        self.kept[which] += len(key) + 16
        if self.kept[which] > KEPT_CHARS:
            store.clear()
            self.kept[which] = len(key) + 16

    def pretokens(self, text: str) -> list[str]:
        if SIMPLE(text):
            return SPACED(text)
        data, out, at = text.encode(), [], 0
        for mapped, _ in self.library.pre_tokenizer.pre_tokenize_str(text):
            out.append(data[at : at + len(mapped)].decode())
            at += len(mapped)
        return out

    def plain(self, text: str) -> list[int]:
        """Counts of all prefixes of a unit, or a part of one, without special tokens in it."""
        space = LEADING(text)[0]
        out, done, at = [0], 0, 0
        if space:  # at a prefix's end the whole run of white space is one pre-token
            counts, place = self.part(space), 0
            for c in space:
                place += len(c.encode())
                out.append(counts[place])
        for p in self.pretokens(text):
            counts = self.part(p)
            if at + len(p) > len(space):
                place = 0
                for k, c in enumerate(p, 1):
                    place += len(c.encode())
                    if at + k > len(space):
                        out.append(done + (2 if k == 2 and p in SHORTENED else counts[place]))
            at += len(p)
            done += counts[-1]
        return out

    def unit(self, text: str) -> list[int]:
        """Counts of all prefixes of a unit. A special token counts once where it is whole, and as text before."""
        found = [(m.start(), m.end()) for m in self.split_special(text)] if "<" in text else []
        if not found:
            return self.plain(text)
        out, at = [0], 0
        for start, end in [*found, (len(text), len(text) + 1)]:
            base = out[at]
            out[at:] = [base + n for n in self.plain(text[at : end - 1])]
            if end <= len(text):
                out.append(out[start] + 1)
            at = end
        return out

    def text(self, units: list[str]) -> int:
        """Tokens of all units."""
        try:
            return sum(map(self.totals.__getitem__, units))
        except KeyError:
            return sum(map(self.total, units))

    def total(self, unit: str) -> int:
        found = self.totals.get(unit)
        if found is None:
            if SIMPLE(unit):  # the last prefix of each of its pre-tokens
                found = sum(self.part(p)[-1] for p in SPACED(unit))
            else:
                found = self.unit(unit)[-1]
            if len(unit) <= 64:
                self._keep(1, self.totals, unit)
                self.totals[unit] = found
        return found


class PrefixCounts:
    """Exact token counts of all prefixes of one text: ``ends[k]`` and ``sums[k]`` are code points and tokens up to unit k, and a unit's table has the rest."""

    def __init__(self, text: str, by: PrefixTable, units: list[str] | None = None):
        self.by, self.units = by, UNITS(text) if units is None else units
        self.ends = [0, *accumulate(map(len, self.units))]
        self.sums = [0, *accumulate(map(by.total, self.units))]

    def total(self) -> int:
        return self.sums[-1]

    def count(self, chars: int) -> int:
        """Tokens of the first ``chars`` code points, as if encoded by themselves."""
        k = bisect_right(self.ends, min(chars, self.ends[-1])) - 1
        return self.sums[k] + (self.by.unit(self.units[k])[chars - self.ends[k]] if k < len(self.units) and chars > self.ends[k] else 0)

    def table(self) -> list[int]:
        """Counts of the prefixes of 0, 1, ... code points."""
        out = [0]
        for unit, before in zip(self.units, self.sums):
            out += [before + n for n in self.by.unit(unit)[1:]]
        return out

    def within(self, budget: int) -> int:
        """Code points of the longest prefix of at most ``budget`` tokens: it ends in the last unit that the budget reaches."""
        if self.total() <= budget:
            return self.ends[-1]
        if budget < 0:
            return 0
        k = bisect_right(self.sums, budget) - 1
        counts, left = self.by.unit(self.units[k]), budget - self.sums[k]
        return self.ends[k] + max(i for i, n in enumerate(counts) if n <= left)


_tables: dict[str, PrefixTable] = {}


def prefix_table(path: str) -> PrefixTable:
    """One for each Python worker; what it knows outlasts a task."""
    if path not in _tables:
        _tables[path] = PrefixTable(path)
    return _tables[path]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, prefixes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, budget_chars and, if asked for, prefix_counts of every document.

    budget_chars: code points of the longest prefix of at most ``limit`` tokens. Null and empty texts: zero throughout.
    Each row stands for itself: repeated rows and ids stay, null ids too; other columns are not read. Very long texts
    and units take time linear in their bytes.
    """
    kind = "doc_id {}, n_bytes long, n_tokens long, over_limit boolean, budget_chars long".format(docs.schema["doc_id"].dataType.simpleString()) + ", prefix_counts array<int>" * prefixes

    def run(batches):
        by = prefix_table(tokenizer)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            rows = []
            for t in texts:
                units = UNITS(t)
                n = by.text(units)
                over = n > limit
                p = PrefixCounts(t, by, units) if over or prefixes else None
                rows.append((len(t.encode()), n, over, p.within(limit) if p else len(t), p.table() if prefixes else None))
            out = [b.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.bool_()), pa.array([r[3] for r in rows], pa.int64())]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "budget_chars"]
            if prefixes:
                out.append(pa.array([r[4] for r in rows], pa.list_(pa.int32())))
                names.append("prefix_counts")
            yield pa.RecordBatch.from_arrays(out, names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, kind)
