"""Freely typed values mapped to the entries of a reference list.

Every written form of an entry (its leaf or another name of it, alone or with its upper levels, in
either order) goes into a BK-tree under the Levenshtein distance, a true metric; the upper levels alone
are forms of no entry. The tree is broadcast, in shards when the list is long. Inside each task the
distinct values of an Arrow batch walk down the tree together: the distances of a whole frontier are
one vectorised dynamic programme, the triangle inequality prunes children, and every form within the
threshold is returned. The nearest form wins. Shards hold disjoint forms, each settled between its
entries beforehand, and their winners merge by the rank used within one tree, so the size of the list
changes no result. Rows never shuffle with a single shard, so a value that a third of all rows hold is
no hot key.

Remarks that people put before or after a name are learned from the values themselves: what stands
beside whole forms of many different entries, in many rows. A value is read with and without them.

Defined cases: null and blank values, and values that are an entry's path, give no row; values without
a letter or digit, longer than any form or beyond the threshold mean no entry (-1); ties go to the
form with the smaller transposition-aware distance, then to the smaller id. An empty list means that
every value is -1.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checked_broadcast, spread, written

#: Forms in a shard's tree (some 100 bytes each), and shards at most.
SHARD_FORMS, MAX_SHARDS = 200_000, 64
#: Edits allowed: at most, as a share of the form's length, and, swaps counting once, of the entry's own name.
MOST_EDITS, FORM_SHARE, NAME_SHARE = 5, 0.4, 0.75
#: A remark: characters at most; different entries it stands beside, as a share of its rows or of all entries, whichever are fewer; share of all rows it is in.
REMARK_CHARS, REMARK_ENTRIES, REMARK_ROWS = 8, 0.25, 1 / 250


def bare(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKC", text).lower() if c.isalnum())


def masked(text: str) -> str:
    """A remark's form: numbers are alike."""
    return re.sub(r"\d+", "0", text)


class Remarks:
    """Reads values without the remarks before and after them; the longest that fits is taken off."""

    def __init__(self, before: Iterable[str] = (), after: Iterable[str] = ()) -> None:
        any_of = lambda ts: "|".join(re.escape(t).replace("0", r"\d+") for t in sorted(ts, key=lambda t: (-len(t), t))) or "(?!)"
        self.before, self.after = re.compile(f"^(?:{any_of(before)})"), re.compile(f"(?:{any_of(after)})$")

    def readings(self, value: str) -> list[str]:
        """A value's letters and digits: as written, and without remarks."""
        text = bare(value)
        inner = self.before.sub("", text)
        return list(dict.fromkeys(r for r in (text, inner, self.after.sub("", text), self.after.sub("", inner)) if r))


def forms_of(cat_id: int, path: str, also: list[str] | None) -> list[tuple[str, int, int]]:
    """(form, cat_id, length of the name in it) of one entry; -1 for its upper levels."""
    *upper, leaf = [p for p in map(bare, (path or "").split("/")) if p] or [""]
    out = []
    for name in [leaf, *(b for a in also or [] if a and (b := bare(a)))]:
        if name:
            out += [(name, cat_id, len(name)), ("".join(upper) + name, cat_id, len(name)), (name + "".join(reversed(upper)), cat_id, len(name))]
            out += [(f, cat_id, len(name)) for u in upper for f in (u + name, name + u)]
    for i in range(len(upper)):
        out += [(f, -1, len(f)) for f in (upper[i], "".join(upper[: i + 1]), "".join(reversed(upper[: i + 1])))]
    return out


def distances(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Levenshtein distances of the rows of a and b (code points, padded with 0) at once."""
    n, width = len(a), b.shape[1]
    steps = np.arange(width + 1, dtype=np.int16)
    prev = np.broadcast_to(steps, (n, width + 1)).copy()
    out = np.where(la == 0, lb, 0).astype(np.int16)
    rows = np.arange(n)
    for i in range(1, int(la.max(initial=0)) + 1):
        cur = np.empty_like(prev)
        cur[:, 0] = i
        np.minimum(prev[:, 1:] + 1, prev[:, :-1] + (b != a[:, i - 1 : i]), out=cur[:, 1:])
        cur -= steps
        np.minimum.accumulate(cur, axis=1, out=cur)
        cur += steps
        ends = la == i
        out[ends] = cur[rows[ends], lb[ends]]
        prev = cur
    return out


def aligned(a: str, b: str) -> int:
    """Edits between two short texts when swapping neighbours counts as one."""
    before, prev = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cur[j] = min(cur[j], before[j - 2] + 1)
        before, prev = prev, cur
    return prev[-1]


def _coded(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    length = np.fromiter(map(len, texts), np.int32, len(texts))
    flat = np.frombuffer("".join(t.ljust(width, "\0") for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat.reshape(len(texts), width), length


class BKTree:
    """A BK-tree in arrays; batches of queries walk down it together."""

    def __init__(self, forms: list[tuple[str, int, int]]) -> None:
        best: dict[str, tuple[int, int]] = {}
        for form, cat, name in forms:  # of entries that share a form the smallest id has it, before none
            if form not in best or (cat >= 0 and (best[form][0] < 0 or cat < best[form][0])):
                best[form] = (cat, name)
        self.forms = sorted(best)
        self.cat = np.array([best[f][0] for f in self.forms], np.int64)
        self.name = np.array([best[f][1] for f in self.forms], np.int32)
        self.width = max(map(len, self.forms), default=1)
        self.code, self.length = _coded(self.forms, self.width)
        n = len(self.forms)
        self.edge, where = np.zeros(n, np.int16), np.zeros(n, np.int64)
        up = np.full(n, -1, np.int64)
        left, taken = np.arange(1, n), {}
        while len(left):  # all forms descend one level at a time; at a free place the first of them settles
            d = distances(self.code[left], self.length[left], self.code[where[left]], self.length[where[left]])
            rest = []
            for i, at, e in zip(left, where[left], d):
                child = taken.get((at, e))
                if child is None:
                    taken[(at, e)] = i
                    up[i], self.edge[i] = at, e
                else:
                    where[i] = child
                    rest.append(i)
            left = np.array(rest, np.int64)
        order = np.argsort(up, kind="stable")
        self.child = order[np.searchsorted(up[order], 0) :] if n else order
        self.first = np.searchsorted(up[self.child], np.arange(n))
        self.count = np.searchsorted(up[self.child], np.arange(n), side="right") - self.first

    def within(self, queries: list[str], radius: np.ndarray, chunk: int = 8_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, form, distance) of every form within each query's radius."""
        if not queries or not self.forms:
            return (np.zeros(0, np.int64),) * 3
        code, length = _coded(queries, max(map(len, queries)))
        stack, found = [(np.arange(len(queries)), np.zeros(len(queries), np.int64))], []
        while stack:
            q, node = stack.pop()
            if len(q) > chunk:
                stack += [(q[i : i + chunk], node[i : i + chunk]) for i in range(0, len(q), chunk)]
                continue
            d = distances(code[q], length[q], self.code[node], self.length[node])
            hit = d <= radius[q]
            if hit.any():
                found.append((q[hit], node[hit], d[hit]))
            n = self.count[node]
            again = np.repeat(np.arange(len(q)), n)
            step = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
            kids = self.child[np.repeat(self.first[node], n) + step]
            near = np.abs(self.edge[kids] - d[again]) <= radius[q][again]  # triangle inequality
            if near.any():
                stack.append((q[again[near]], kids[near]))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found))

    def meant(self, values: list[str], remarks: Remarks = Remarks()) -> list[tuple[int, int, int]]:
        """(distance, swap-aware distance, cat_id) of each value's nearest form; a large distance and -1 if none is near."""
        read = [[r for r in remarks.readings(v) if len(r) <= self.width + MOST_EDITS] for v in values]
        flat = sorted({r for rs in read for r in rs})
        best: dict[str, tuple] = {}
        for most in (0, 1, 2, MOST_EDITS):  # a value found within a smaller radius has nothing nearer outside it
            todo = [r for r in flat if r not in best]
            edits = np.array([min(most, int(FORM_SHARE / (1 - FORM_SHARE) * len(r))) for r in todo], np.int64)
            for q, node, d in zip(*self.within(todo, edits)):
                text, form = todo[q], self.forms[node]
                if d <= FORM_SHARE * self.length[node] and (text not in best or d <= best[text][0]):
                    swaps = aligned(text, form) if d else 0
                    if swaps < max(1, NAME_SHARE * self.name[node]):
                        rank = (int(d), swaps, int(self.cat[node]))
                        best[text] = min(best.get(text, rank), rank)
        none = (10**6, 0, -1)
        return [min((best.get(r, none) for r in rs), default=none) for rs in read]


def settled_forms(ref: DataFrame) -> DataFrame:
    """(form, cat_id, name): every form once, with the entry that has it as within one tree."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(*f, i) for c, p, a in zip(b["cat_id"], b["path"], b["also_called"]) for i, f in enumerate(forms_of(c, p, None if a is None else list(a)))]
            yield pd.DataFrame(rows, columns=["form", "cat_id", "name", "place"])

    forms = ref.select("cat_id", "path", "also_called").mapInPandas(run, "form string, cat_id long, name int, place int")
    rank = F.struct(F.col("cat_id") < 0, "cat_id", "place")
    return forms.groupBy("form").agg(F.min_by(F.struct("cat_id", "name"), rank).alias("m")).select("form", "m.cat_id", "m.name")


def learned(src: DataFrame, forms: DataFrame, shards: int) -> Remarks:
    """The remarks in src(_value) around whole forms(form, cat_id)."""
    total = src.count()
    found = None
    for s in range(shards):
        own = {r.form: r.cat_id for r in _shard(forms, s, shards).collect() if r.cat_id >= 0}  # about SHARD_FORMS at most

        def run(batches: Iterator[pd.DataFrame], own: dict[str, int] = own) -> Iterator[pd.DataFrame]:
            for b in batches:
                n: Counter = Counter()
                for value, k in b["_value"].value_counts().items():
                    text = bare(value)
                    for i in range(1, min(len(text) - 1, REMARK_CHARS) + 1):
                        if (entry := own.get(text[i:])) is not None:
                            n["before", masked(text[:i]), entry] += k
                        if (entry := own.get(text[:-i])) is not None:
                            n["after", masked(text[-i:]), entry] += k
                yield pd.DataFrame([(*key, k) for key, k in n.items()], columns=["side", "remark", "entry", "n"])

        one = src.select("_value").mapInPandas(run, "side string, remark string, entry long, n long").groupBy("side", "remark", "entry").agg(F.sum("n").alias("n"))
        found = one if found is None else found.unionByName(one)
    entries = forms.where("cat_id >= 0").agg(F.countDistinct("cat_id")).first()[0]
    often = found.groupBy("side", "remark").agg(F.countDistinct("entry").alias("entries"), F.sum("n").alias("n"))
    many = F.greatest(F.lit(2.0), REMARK_ENTRIES * F.least(F.lit(entries), F.col("n")))
    often = often.where((F.col("entries") >= many) & (F.col("n") >= REMARK_ROWS * total)).collect()  # few: each takes its share of the rows
    return Remarks([r.remark for r in often if r.side == "before"], [r.remark for r in often if r.side == "after"])


def _shard(forms: DataFrame, s: int, shards: int) -> DataFrame:
    return forms.where(F.pmod(F.hash("form"), F.lit(shards)) == s)


def mapped(rows: DataFrame, key: str, value: str, ref: DataFrame) -> DataFrame:
    """(key, cat_id): the entry meant by each value that isn't blank or a path; -1 if none.

    ref(cat_id, path, also_called).
    """
    paths = ref.select(F.col("path").alias("_path")).where("_path is not null").distinct()
    forms = written(settled_forms(ref))
    shards = max(1, -(-forms.count() // SHARD_FORMS))
    if shards > MAX_SHARDS:
        raise ValueError(f"the reference list needs {shards} shards; {MAX_SHARDS} are allowed")
    src = rows.select(F.col(key).alias("_key"), F.col(value).alias("_value")).where(F.col("_value").rlike(r"(?U)[^\s\x1c-\x1f]"))
    src = src.join(checked_broadcast(paths), F.col("_value") == F.col("_path"), "left_anti")
    src = spread(src)
    remarks = learned(src, forms, shards)
    kind = src.schema["_key"].dataType.simpleString()
    extra = [] if shards == 1 else ["_value", "edits", "swaps"]
    schema = f"_key {kind}, cat_id int" + (", _value string, edits int, swaps int" if extra else "")
    found = None
    for s in range(shards):
        tree = src.sparkSession.sparkContext.broadcast(BKTree([tuple(r) for r in _shard(forms, s, shards).collect()]))  # about SHARD_FORMS at most

        def run(batches: Iterator[pd.DataFrame], tree=tree) -> Iterator[pd.DataFrame]:
            known: dict[str, tuple[int, int, int]] = {}
            for b in batches:
                if len(known) > 200_000:
                    known.clear()
                new = [v for v in b["_value"].unique() if v not in known]
                known |= zip(new, tree.value.meant(new, remarks))
                b["edits"], b["swaps"], b["cat_id"] = zip(*(known[v] for v in b["_value"])) if len(b) else ([], [], [])
                yield b[["_key", "cat_id", *extra]]

        one = src.mapInPandas(run, schema)
        if shards > 1:  # written at once, so that no more than one shard's tree is broadcast
            one = written(one)
            tree.destroy()
        found = one if found is None else found.unionByName(one)
    if shards > 1:  # every row comes once from each shard; rows that are equal stay as many
        best = F.min_by("cat_id", F.struct("edits", "swaps", "cat_id")).alias("cat_id")
        found = found.groupBy("_key", "_value").agg(best, (F.count("*") / shards).cast("int").alias("_n"))
        found = found.select("_key", "cat_id", F.explode(F.array_repeat(F.lit(0), F.col("_n"))))
    return found.select(F.col("_key").alias(key), "cat_id")
