"""Texts that look alike made equal: one ordinary form for every class of look-alikes.

Look-alike pairs link code points and short strings: width and code variants, spaces, invisible
characters (like the empty string), a letter with combining accents and its composed form, letters of
other scripts that look Latin, radicals and the one or more ideographs they look like. Union-find closes
them into classes. The representative of a class is its most frequent ordinary member in the corpus,
counted over all texts; it decides where a class has several, as 月 and 肉 beside their common radical,
and 1,900 of the classes have only one. A multi-pattern automaton then rewrites greedily, longest
pattern first, until nothing changes. Ordinary members are never rewritten themselves; those in another
script are rewritten only inside words that are not wholly in that script.

Defined cases: null stays null, '' stays ''; texts of any length are rewritten whole; a text in
ordinary form gives no row. The tables of classes depend on Unicode alone, a few thousand entries.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import spread

# Letters that look like a Latin letter, by script, each followed by it.
CYRILLIC = "АA ВB СC ЕE НH ІI ЈJ КK МM ОO РP ЅS ТT УY ҮY ХX ԚQ ԜW аa сc ԁd еe һh іi јj кk ӏl оo рp ԛq ѕs уy үy хx ԝw".split()
GREEK = "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX αa ιi κk νv οo ρp υu χx".split()
# Radicals without a compatibility form, each followed by the ideographs it looks like.
RADICALS = (
    "⺁厂 ⺂乛 ⺃乚 ⺄乙 ⺅亻 ⺆冂 ⺇几 ⺉刂 ⺊卜 ⺋㔾 ⺌小 ⺍小 ⺎兀 ⺏尣 ⺐尢 ⺒巳 ⺓幺 ⺔彑 ⺕彐 ⺖忄 ⺗心 ⺘扌 ⺙攵 ⺛旡 ⺜日曰 ⺝月 ⺞歺 ⺠民 ⺡氵 ⺢水 ⺣灬 ⺤爫 ⺥爫 ⺦丬 ⺧牛 ⺨犭 "
    "⺩王玉 ⺪疋 ⺫目罒 ⺬示 ⺭礻 ⺮竹 ⺯糹 ⺰纟 ⺱罓 ⺲罒 ⺳罓 ⺴罓 ⺶羊 ⺷羊 ⺸羊 ⺹耂 ⺺聿 ⺻聿 ⺼月肉 ⺽臼 ⺾艹 ⺿艹 ⻀艹 ⻁虎 ⻂衤 ⻃覀 ⻄西 ⻅见 ⻆角 ⻇角 ⻈讠 ⻉贝 ⻊足 ⻋车 ⻌辶 ⻍辶 ⻎辶 ⻏阝 ⻐钅 "
    "⻑長 ⻒镸 ⻓长 ⻔门 ⻕阜 ⻖阝 ⻗雨 ⻘青 ⻙韦 ⻚页 ⻛风 ⻜飞 ⻝食 ⻞食 ⻟飠 ⻠饣 ⻡首 ⻢马 ⻣骨 ⻤鬼 ⻥鱼 ⻦鸟 ⻧卤 ⻨麦 ⻩黄 ⻪黾 ⻫斉 ⻬齐 ⻭歯 ⻮齿 ⻯竜 ⻰龙 ⻱龜 ⻲亀"
).split()
SPACES = "               　"
#: Code blocks whose members are written by their compatibility form: radicals, compatibility ideographs, mathematical letters.
CODE_BLOCKS = ((0x2E80, 0x2FD5), (0xF900, 0xFAFF), (0x1D400, 0x1D7FF), (0x2F800, 0x2FA1F))
_WORD = re.compile(r"[A-Za-zÀ-ɏͰ-ϿЀ-ԯḀ-῿̀-ͯ]+")
_LATIN = re.compile(r"[A-Za-zÀ-ɏḀ-ỿ]")
_OTHER = (re.compile(r"[Ͱ-Ͽἀ-῿]"), re.compile(r"[Ѐ-ԯ]"))


@lru_cache(1)
def invisible() -> str:
    """Format characters, joiners and variation selectors."""
    found = [chr(i) for i in range(0x110000) if unicodedata.category(chr(i)) == "Cf" and not 0x600 <= i <= 0x6DD and i not in (0x70F, 0x8E2, 0x110BD, 0x110CD)]
    return "".join(found) + "͏ᅟᅠ឴឵ㅤﾠ" + "".join(map(chr, range(0xFE00, 0xFE10)))


@lru_cache(1)
def pairs() -> list[tuple[str, str, str]]:
    """(member, member, kind): what looks alike; kind says when the first is rewritten."""
    out = [(c, "", "always") for c in invisible()] + [(c, " ", "always") for c in SPACES]
    for i in [*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)]:
        out.append((chr(i), unicodedata.normalize("NFKC", chr(i)), "always"))
    for low, high in CODE_BLOCKS:
        out += [(chr(i), f, "always") for i in range(low, high + 1) if len(f := unicodedata.normalize("NFKC", chr(i))) == 1 and f != chr(i)]
    out += [(r[0], one, "always") for r in RADICALS for one in r[1:]]
    for i in range(0xC0, 0x2000):
        ch = chr(i)
        apart = unicodedata.normalize("NFD", ch)
        if len(apart) > 1 and unicodedata.normalize("NFC", apart) == ch:
            half = unicodedata.normalize("NFC", apart[:-1]) + apart[-1]
            out += [(s, ch, "always") for s in {apart, half}]
    latin = {p[0]: p[1] for p in CYRILLIC + GREEK}
    out += [(a, b, "mixed") for a, b in latin.items()]
    for i in range(0x370, 0x2000):  # accented letters of other scripts look like the accented Latin ones
        apart = unicodedata.normalize("NFD", chr(i))
        if len(apart) > 1 and apart[0] in latin and len(to := unicodedata.normalize("NFC", latin[apart[0]] + apart[1:])) == 1:
            out.append((chr(i), to, "mixed"))
    return out


def classes() -> dict[str, list[str]]:
    """Members by root: the transitive classes of all pairs, by union-find with path halving."""
    up: dict[str, str] = {}

    def root(x: str) -> str:
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b, _ in pairs():
        if (x := root(a)) != (y := root(b)):
            up[max(x, y)] = min(x, y)
    out = defaultdict(list)
    for x in list(up):
        out[root(x)].append(x)
    return out


def rewrites(seen: dict[int, int]) -> tuple[dict[str, str], dict[str, str]]:
    """(always, mixed): what each pattern becomes, given how often every code point occurs.

    The representative is the most frequent of a class's ordinary members, those that no pair rewrites
    unconditionally; among equals the smallest. The Latin members represent a class in mixed words.
    """
    never_kept = {a for a, _, kind in pairs() if kind == "always"}
    other_script = {a for a, _, kind in pairs() if kind == "mixed"}
    always, mixed = {}, {}
    rate = lambda m: (-(seen.get(ord(m), 0) if len(m) == 1 else 0), len(m), m)
    for members in classes().values():
        latin = [m for m in members if m not in never_kept and m not in other_script]
        best = min(latin, key=rate)
        for m in members:
            if m in never_kept:
                always[m] = best
            elif m in other_script:
                mixed[m] = best
    return always, mixed


class Rewriter:
    """Greedy rewriting by an Aho-Corasick automaton over all patterns."""

    def __init__(self, always: dict[str, str], mixed: dict[str, str]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for pattern, to in always.items():
            self.automaton.add_word(pattern, (len(pattern), to))
        self.automaton.make_automaton()
        self.mixed = str.maketrans(mixed)
        self.other = re.compile("[" + "".join(mixed) + "]")

    def once(self, text: str) -> str:
        out, at = [], 0
        for end, (n, to) in self.automaton.iter_long(text):
            out += (text[at : end - n + 1], to)
            at = end + 1
        return "".join(out) + text[at:] if at else text

    def word(self, m: re.Match) -> str:
        w = m.group()
        if self.other.search(w) and (_LATIN.search(w) or all(s.search(w) for s in _OTHER)):
            return w.translate(self.mixed)
        return w

    def plain(self, text: str) -> str:
        while True:  # removals, letters and accents can meet anew; each pass shortens the text or settles letters
            now = self.once(text)
            now = _WORD.sub(self.word, now) if self.other.search(now) else now
            if now == text:
                return text
            text = now


def frequencies(texts: DataFrame, col: str) -> DataFrame:
    """(cp, n): how often every code point occurs; at most one row per code point and batch is shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cps, n = np.unique(np.frombuffer("".join(b["t"]).encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)
            yield pd.DataFrame({"cp": cps.astype("int32"), "n": n})

    return texts.where(F.col(col).isNotNull()).select(F.col(col).alias("t")).mapInPandas(count, "cp int, n long").groupBy("cp").agg(F.sum("n").alias("n"))


def suspicious(text: Column) -> Column:
    """Whether a text holds any character that some pattern or word rule could change."""
    singles = sorted({ord(c) for a, _, kind in pairs() if kind == "always" for c in a if len(a) == 1 or unicodedata.combining(c)})
    spans: list[list[int]] = []
    for i in singles:
        if spans and i == spans[-1][1] + 1:
            spans[-1][1] = i
        else:
            spans.append([i, i])
    inside = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans)
    return text.rlike(f"[{inside}\\p{{IsGreek}}\\p{{IsCyrillic}}]")


def ordinary(texts: DataFrame, col: str, keep: list[str], seen: dict[int, int] | None = None) -> DataFrame:
    """(*keep, plain): a row for each text in col that isn't in its ordinary form.

    seen gives code point frequencies, at most one entry per code point of Unicode; by default those of
    the texts themselves.
    """
    if seen is None:
        seen = {r.cp: r.n for r in frequencies(texts, col).collect()}  # bounded by Unicode
    always, mixed = rewrites(seen)
    src = spread(texts).where(suspicious(F.col(col))).select(*(F.col(k).alias(f"_{i}") for i, k in enumerate(keep)), F.col(col).alias("_t"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rewriter = Rewriter(always, mixed)
        for b in batches:
            b["plain"] = [rewriter.plain(t) for t in b["_t"]]
            yield b[b["plain"] != b["_t"]].drop(columns="_t")

    fields = ", ".join(f"_{i} {src.schema[f'_{i}'].dataType.simpleString()}" for i in range(len(keep)))
    out = src.mapInPandas(run, f"{fields}, plain string")
    return out.select(*(F.col(f"_{i}").alias(k) for i, k in enumerate(keep)), "plain")
