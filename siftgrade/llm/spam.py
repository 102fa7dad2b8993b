"""Pages of repeated keywords, links, menus, goods lines or tags instead of sentences.

Two measures decide together:

- Clause structure. Which tokens (words, or characters of scripts without spaces) make clauses is counted
  over the whole corpus: those that are widely spread over the pages and whose share of all tokens in
  segments with a sentence mark at the end is at least AFFINITY times their share in lines and fragments
  without one. A segment has clause structure if such tokens are dense in it. No words are given.
- Repetition. A page's suffix automaton over its tokens gives at every position the longest suffix
  that the page repeats, or repeats so often; the union of those of a least length is what repeated
  maximal substrings cover. Where they come back at least once per KEYWORD_EVERY characters they are
  keywords. Hashed runs of the least length, whose union is the same or, where hashes meet, larger, first
  rule out the pages that stay mostly prose whatever the automaton finds. Of pages that are suspect so
  far a second automaton, over the characters, measures the cover.

Characters are suspect in segments without clause structure, and where keywords stand. A segment with a
few clause tokens may be a clause that has lost its marks, and stand twice like any passage: there
characters are suspect only under substrings that the page repeats three times. A page is spam if most
of it is suspect and repetition covers at least LEAST_REPEATED more of its suspect letters than of the
same characters shuffled, so that names, headings or figures that don't repeat themselves are no spam.
Numbers are no clause tokens, and count as one digit in that cover, or goods lines would differ by their
prices.

Defined cases: null and empty texts give no row; a page without any repetition is no spam however
short; one passage over and over is keywords. Texts of any length are measured whole. Beyond
AUTOMATON_LENGTH tokens or characters the cover is taken from hashed runs of exactly the least length,
whose union is the same; two different runs of n share a 64-bit hash with a chance below n * n / 2**64.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread, written

#: Share of a page's characters that is suspect at least, and cover of its letters by repetition above chance.
MOST_PROSE, LEAST_REPEATED = 0.5, 0.15
#: Clause tokens: share of all pages they are on, and how much more often in sentences than in fragments, at least.
LEAST_SPREAD, AFFINITY = 0.01, 10.0
#: Share of a segment's tokens that are clause tokens, at least, where it has clause structure; from DOUBT of them and that
#: share on it may have, and only what it repeats DOUBT_TIMES is suspect.
DENSITY, DOUBT, DOUBT_SHARE, DOUBT_TIMES = 0.125, 2, 0.0625, 3
#: Keywords: characters per occurrence at most, occurrences and tokens at least.
KEYWORD_EVERY, KEYWORD_TIMES, KEYWORD_HAN, KEYWORD_WORDS = 100, 5, 4, 2
#: Lengths in characters of repeated substrings in a page mostly of single tokens, and in another, beside that of chance.
LENGTHS_HAN, LENGTHS_OTHER = (2, 3, 4), (6,)
#: Tokens or characters up to which an automaton is built, some 300 bytes each.
AUTOMATON_LENGTH = 500_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
OTHER, SINGLE, LETTER, DIGIT = 0, 1, 2, 3
_KIND, _MARK, _LINE, _POINT, _GAP = 3, 4, 8, 16, 32  # bits of a code point: its kind; sentence mark, line end, full stop, space


@lru_cache(1)
def _bits() -> np.ndarray:
    """What every code point is; single tokens are characters of scripts written without spaces."""
    out = np.zeros(0x110000, np.uint8)
    for i in [*range(0x3040), *range(0xA000, 0x20000)]:
        c = unicodedata.category(chr(i))
        out[i] = LETTER if c[0] == "L" or c[0] == "M" else DIGIT if c == "Nd" else OTHER
    for low, high in ((0x3040, 0x3100), (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00), (0x20000, 0x323B0)):
        out[low:high] = SINGLE
    for chars, bit in (("。！？!?", _MARK), ("\n", _LINE), (".", _POINT), (" \t\r", _GAP)):
        for c in chars:
            out[ord(c)] |= bit
    return out


@lru_cache(1)
def _powers() -> np.ndarray:
    return np.cumprod(np.concatenate(([np.uint64(1)], np.full(4095, _BASE, np.uint64))))


class Pages:
    """Texts as tokens and segments in arrays, all in one row: token i starts at start[i] and lies in segment of[i]."""

    def __init__(self, texts: list[str]) -> None:
        low = [t.lower() for t in texts]
        self.offset = np.concatenate(([0], np.cumsum([len(t) + 1 for t in low]))).astype(np.int64)
        code = np.frombuffer(("\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        self.code = code
        bits = _bits()[code]
        kind = bits & _KIND
        before = np.concatenate((np.zeros(1, np.uint8), kind[:-1]))
        first = (kind == SINGLE) | (kind > SINGLE) & (kind != before)
        self.start = np.flatnonzero(first)
        self.size = np.append(self.start[1:], len(code)) - self.start
        mark = (bits & _MARK > 0) | (bits & _POINT > 0) & (before >= SINGLE) & (np.append(bits[1:], _LINE) & (_LINE | _GAP) > 0)
        ends = mark | (bits & _LINE > 0)
        seg = np.cumsum(ends) - ends
        self.chars = np.bincount(seg)
        self.sentence = np.zeros(len(self.chars), bool)  # whether a segment ends with a sentence mark
        self.sentence[seg[mark]] = True
        self.of, self.seg = seg[self.start], seg
        self.token, self.number = np.zeros(0, np.uint64), kind[self.start] == DIGIT
        self.han = 2 * np.add.reduceat(kind == SINGLE, self.offset[:-1], dtype=np.int64) >= np.add.reduceat(kind != OTHER, self.offset[:-1], dtype=np.int64) if texts else np.zeros(0, bool)
        if len(self.start):
            value = np.zeros(len(code), np.uint64)
            letters, singles = np.flatnonzero(kind >= LETTER), np.flatnonzero(kind == SINGLE)
            place = letters - self.start[np.cumsum(first)[letters] - 1]
            value[letters] = code[letters] * _powers()[place & 4095]
            value[singles] = code[singles]
            self.token = np.add.reduceat(value, self.start)
        self.cut = np.searchsorted(self.start, self.offset)  # the first token of each text

    def clause_counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(tokens, occurrences in sentences, other occurrences, texts with it) of each distinct token; all numbers are token 0."""
        which, tokens = pd.factorize(np.where(self.number, np.uint64(0), self.token))
        n, said = len(tokens), self.sentence[self.of]
        text = np.repeat(np.arange(len(self.cut) - 1), np.diff(self.cut))
        texts = pd.unique(text * max(1, n) + which) % max(1, n)
        return tokens, np.bincount(which[said], minlength=n), np.bincount(which[~said], minlength=n), np.bincount(texts, minlength=n)

    def bare(self, clause: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which segments lack clause structure, and which of them may have it after all, given the sorted clause tokens."""
        at = np.searchsorted(clause, self.token)
        hit = clause[np.minimum(at, len(clause) - 1)] == self.token if len(clause) else np.zeros(len(self.token), bool)
        hit &= ~self.number
        n = np.bincount(self.of, minlength=len(self.chars))
        hits = np.bincount(self.of[hit], minlength=len(self.chars))
        bare = hits < np.maximum(1, DENSITY * n)
        return bare, bare & (hits >= np.maximum(DOUBT, DOUBT_SHARE * n))


class Automaton:
    """The suffix automaton of a sequence: suffix links and lengths of its states, and the state of every prefix.

    Two neighbours that stand together once only are in no repeated substring: a stretch ends between
    them, and the automaton is that of all stretches. Repeated substrings of two and more are the same.
    """

    def __init__(self, sequence: np.ndarray) -> None:
        which, kinds = pd.factorize(sequence)
        pair, pairs = pd.factorize(which[:-1] * max(1, len(kinds)) + which[1:])
        again = np.concatenate(([False], np.bincount(pair, minlength=len(pairs))[pair] > 1, [False]))[: len(which) + 1]
        kept = np.flatnonzero(again[:-1] | again[1:])
        none: dict[int, int] = {}  # stands for the transitions of states that have none yet
        follow, link, length, at = [{}], [-1], [0], []
        last = 0
        for c, joined in zip(which[kept].tolist(), again[kept].tolist()):
            if not joined:
                last = 0
            p, new = last, len(follow)
            while p >= 0:
                next_ = follow[p]
                if c in next_:
                    break
                if next_ is none:
                    follow[p] = {c: new}
                else:
                    next_[c] = new
                p = link[p]
            if p != last:  # else the stretch so far was read before
                follow.append(none)
                length.append(length[last] + 1)
                link.append(0)
            if p >= 0:
                q, here = next_[c], next_[c]
                if length[p] + 1 != length[q]:
                    here = len(follow)
                    follow.append(follow[q].copy())
                    length.append(length[p] + 1)
                    link.append(link[q])
                    link[q] = here
                    first = p
                    while p >= 0 and (next_ := follow[p]).get(c) == q:
                        next_[c] = here
                        p = link[p]
                    p = first
                if p == last:
                    last = here
                    at.append(here)
                    continue
                link[new] = here
            last = new
            at.append(new)
        self.link, self.length, self.at = np.array(link), np.array(length), np.zeros(len(which), np.int64)
        self.at[kept] = at

    def reach(self, times: int = 2) -> np.ndarray:
        """At every position the length of the longest suffix that occurs so often in the sequence."""
        if times <= 2:  # a state with another below it, or met again, occurs twice, and so does what any state links to
            twice = np.bincount(self.at, minlength=len(self.link)) > 1
            twice[self.link[1:]] = True
            twice[0] = True
            return np.where(twice[self.at], self.length[self.at], self.length[self.link[self.at]])
        link, length = self.link.tolist(), self.length.tolist()
        count = [0] * len(link)
        for s in self.at.tolist():
            count[s] += 1
        order = np.argsort(self.length, kind="stable").tolist()
        for s in reversed(order[1:]):
            count[link[s]] += count[s]
        longest = [0] * len(link)
        for s in order[1:]:
            longest[s] = length[s] if count[s] >= times else longest[link[s]]
        return np.array(longest)[self.at] if len(self.at) else np.zeros(0, np.int64)


def covered(reach: np.ndarray, least: int) -> np.ndarray:
    """Which positions those suffixes cover, of at least this length."""
    ends = np.flatnonzero(reach >= least)
    n = len(reach) + 1
    return np.cumsum(np.bincount(ends - reach[ends] + 1, minlength=n) - np.bincount(ends + 1, minlength=n))[:-1] > 0


def run_cover(sequence: np.ndarray, least: int, times: int = 2) -> np.ndarray:
    """The same cover from the runs of exactly this length that occur so often, by their hashes."""
    n = max(0, len(sequence) - least + 1)
    runs = np.zeros(n, np.uint64)
    for i in range(least):
        runs = runs * _BASE + sequence[i : i + n].astype(np.uint64)
    _, which, count = np.unique(runs, return_inverse=True, return_counts=True)
    out = np.zeros(len(sequence), bool)
    for i in range(least if n else 0):
        out[i : i + n] |= count[which] >= times
    return out


class Repetition:
    """What repeated substrings cover of a sequence of numbers."""

    def __init__(self, sequence: np.ndarray) -> None:
        self.sequence = sequence
        self.automaton = Automaton(sequence) if len(sequence) <= AUTOMATON_LENGTH else None
        self.reach: dict[int, np.ndarray] = {}

    def cover(self, least: int, times: int = 2) -> np.ndarray:
        if self.automaton is None:
            return run_cover(self.sequence, least, times)
        if times not in self.reach:
            self.reach[times] = self.automaton.reach(times)
        return covered(self.reach[times], least)


def above_chance(code: np.ndarray, suspect: np.ndarray, han: bool) -> float:
    """Of the suspect letters, the share that repetition covers, less what it covers in the characters shuffled."""
    kind = _bits()[code] & _KIND
    digit = kind == DIGIT
    kept = ~(digit & np.concatenate(([False], digit[:-1])))
    code, letter = np.where(digit, np.uint32(48), code)[kept], suspect[kept] & ((kind == LETTER) | (kind == SINGLE))[kept]
    if not letter.any():
        return 0.0
    part = np.unique(code, return_counts=True)[1] / len(code)
    same = float((part * part).sum())
    chance = 1 + int(np.ceil(2 * np.log(len(code)) / -np.log(same))) if same < 1 else 2
    mixed, whole = np.random.default_rng(0).permutation(code), Repetition(code)
    return max(float(whole.cover(n)[letter].mean()) - float(run_cover(mixed, n).mean()) for n in {*(LENGTHS_HAN if han else LENGTHS_OTHER), chance})


def judged(texts: list[str], clause: np.ndarray) -> list[tuple[float, float, float]]:
    """(share without clause structure, suspect share, cover of suspect letters by repetition above chance) of each text."""
    pages = Pages(texts)
    bare, doubtful = pages.bare(clause)
    out = []
    for i in range(len(texts)):
        low, high, a, b = pages.offset[i], pages.offset[i + 1] - 1, pages.cut[i], pages.cut[i + 1]
        if a == b:
            out.append((1.0, 1.0, 0.0))
            continue
        suspect, length = bare[pages.seg[low:high]], int(high - low)
        bare_share = float(suspect.mean())
        han = bool(pages.han[i])
        least = KEYWORD_HAN if han else KEYWORD_WORDS
        start, size = pages.start[a:b] - low, pages.size[a:b].copy()
        size[-1] = length - start[-1]
        token = pages.token[a:b]
        # hashed runs cover no less than the automaton does: where they leave most of it prose, it is prose
        if bare_share > MOST_PROSE or bare_share + size[run_cover(token, least)].sum() / length > MOST_PROSE:
            doubt, bared = doubtful[pages.seg[low:high]], suspect

            def marked(cover: Callable[[int, int], np.ndarray]) -> np.ndarray:
                often = cover(least, max(KEYWORD_TIMES, -(-length // KEYWORD_EVERY)))
                if doubt.any():
                    often = often | doubt[start] & cover(least, DOUBT_TIMES)
                return bared & ~doubt | np.concatenate((np.zeros(start[0], bool), np.repeat(often, size)))

            suspect = marked(partial(run_cover, token))
            if suspect.mean() > MOST_PROSE:
                suspect = marked(Repetition(token).cover)
        share = float(suspect.mean())
        out.append((bare_share, share, above_chance(pages.code[low:high], suspect, han) if share > MOST_PROSE else 0.0))
    return out


def clause_tokens(docs: DataFrame, text: str) -> np.ndarray:
    """The tokens, as sorted hashes, that make clauses in the corpus; counted over all pages. Numbers (token 0) make none."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            pages = Pages(b["_text"].tolist())
            tokens, said, bare, texts = pages.clause_counts()
            total = pd.DataFrame({"token": [0], "total": [True], "said": [said.sum()], "bare": [bare.sum()], "pages": [len(b)]})
            yield pd.concat([total, pd.DataFrame({"token": tokens.view(np.int64), "total": False, "said": said, "bare": bare, "pages": texts})])

    src = docs.where(F.col(text) != "").select(F.col(text).alias("_text"))
    counts = spread(src).mapInPandas(count, "token long, total boolean, said long, bare long, pages long")
    counts = written(counts.groupBy("token", "total").agg(F.sum("said").alias("said"), F.sum("bare").alias("bare"), F.sum("pages").alias("pages")))
    total = counts.where("total").agg(F.sum("said").alias("said"), F.sum("bare").alias("bare"), F.sum("pages").alias("pages"))
    total = F.broadcast(total.select(*(F.col(c).alias(f"{c}_all") for c in ("said", "bare", "pages"))))  # one row
    chosen = counts.where("not total and token <> 0").crossJoin(total).where(
        (F.col("pages") >= LEAST_SPREAD * F.col("pages_all")) & (F.col("said") / F.greatest("said_all", F.lit(1.0)) >= AFFINITY * F.col("bare") / F.greatest("bare_all", F.lit(1.0)))
    )  # no more than the tokens of an average page over LEAST_SPREAD
    return np.sort(np.array([r.token for r in chosen.select("token").collect()], np.int64).view(np.uint64))


def spam(docs: DataFrame, key: str, text: str, clause: np.ndarray | None = None) -> DataFrame:
    """(key, bare_share, suspect_share, repeated_share) of the pages that are spam; clause tokens are those of docs unless given."""
    clause = clause_tokens(docs, text) if clause is None else clause

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = np.array(judged(b["_text"].tolist(), clause)).reshape(-1, 3)
            out = pd.DataFrame({"_key": b["_key"], "bare_share": got[:, 0], "suspect_share": got[:, 1], "repeated_share": got[:, 2]})
            yield out[(out["suspect_share"] > MOST_PROSE) & (out["repeated_share"] >= LEAST_REPEATED)]

    src = spread(docs).where(F.col(key).isNotNull() & (F.col(text) != "")).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = src.schema["_key"].dataType.simpleString()
    return src.mapInPandas(run, f"_key {kind}, bare_share double, suspect_share double, repeated_share double").withColumnRenamed("_key", key)
