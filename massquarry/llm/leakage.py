"""Evaluation texts leaking into training text: joined windows of canonical templates.

Both sides are written as templates: words become lower-case, and numbers, units and names become typed placeholders; a
run of number words, digits or names is one placeholder. Windows of `window` words, and of `window` placeholders and
words where runs make that a longer passage, are hashed and joined. A joined window is then checked slot by slot: it is an
exact leak where every slot holds the item's own text, and a re-parameterised one where every slot text of the item
stands for one slot text of the document throughout the window, and the other way round.

A name is a word of letters and digits mixed; a word that ends as names of compounds do; a word that differs between item
windows that are otherwise equal; and, in a second template of the same window, a capitalised word within a sentence. The
first three do not depend on letter case, so that copies in any case have the same template.

Windows with fewer than `literal` words outside of slots, such as rows of numbers, say little about where they come from:
their slots are hashed into their key, so they join their exact copies only.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

# Words that stand for numbers and for units, and endings of names of compounds.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    "thirty forty fifty sixty seventy eighty ninety hundred thousand million half third quarter dozen".split()
)
UNIT_WORDS = frozenset(
    "ev kev mev v kv mv volt volts da dalton daltons mda ppm min minute minutes s second seconds h hour hours ms c k degree degrees ml ul nl µl l "
    "microlitre microlitres millilitre millilitres g mg ug µg kg gram grams m cm mm nm µm percent count counts cycle cycles scan scans injection injections "
    "peak peaks loss losses fraction fractions step steps mol mmol µmol hz khz bar".split()
)
NAME_ENDINGS = ("oside", "amide", "idine", "amine", "feine", "mine", "cine", "nine", "tine", "line", "rine", "zole", "quinone", "terene", "ylene", "ulene", "oxide", "oate", "inate", "ycin", "illin", "ol acid", "erol", "enol", "carol", "terol")

WORDS, NUMBER, UNIT, NAME = range(4)
_HOLDER = {NUMBER: "<number>", UNIT: "<unit>", NAME: "<name>"}
_WORD = re.compile("\x01?[^\\W_]+")
_WITHIN = re.compile(r"(?<=[^\W_][ ,;] )[A-Z][a-z]+|(?<=[^\W_] )[A-Z][a-z]+")
_MULT, _MULT2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LIMIT = 1_000_000
_NONE = np.zeros(0, np.uint64)


def kind_of(word: str, varies: bool = False) -> int:
    """WORDS, NUMBER, UNIT or NAME for a lower-case word."""
    if word.isdigit() or word in NUMBER_WORDS:
        return NUMBER
    if word in UNIT_WORDS:
        return UNIT
    if any(c.isdigit() for c in word) or varies or (len(word) > 6 and word.endswith(NAME_ENDINGS)):
        return NAME
    return WORDS


def words_of(text: str) -> tuple[list[str], list[bool]]:
    """Lower-case words, and which of them are capitalised within a sentence."""
    found = _WORD.findall(_WITHIN.sub("\x01\\g<0>", text.replace("\x01", " ")).lower())
    return [w.lstrip("\x01") for w in found], [w[0] == "\x01" for w in found]


def _roll(acc: np.ndarray, v: np.ndarray, mult: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        acc = (acc ^ v) * mult
        return acc ^ (acc >> np.uint64(29))


class Templates:
    """Windows of texts. What is known of a word is remembered; the memory is emptied at a fixed size."""

    def __init__(self, size: int, literal: int, varying: np.ndarray | None = None):
        self.size, self.literal, self.varying = size, literal, _NONE if varying is None else varying
        self.known: dict[str, int] = {}
        self.facts: list[tuple[int, int, int]] = []

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self.facts) > _LIMIT:
            self.known, self.facts = {}, []
        known = self.known
        out = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
        for k in np.flatnonzero(out < 0):
            w = words[k]
            if w not in known:
                known[w] = len(self.facts)
                h = xxhash.xxh64_intdigest(w)
                at = np.searchsorted(self.varying, np.uint64(h))
                kind = kind_of(w, at < len(self.varying) and int(self.varying[at]) == h)
                self.facts.append((xxhash.xxh64_intdigest(_HOLDER[kind]) if kind else h, h, kind))
            out[k] = known[w]
        return out

    def _hash(self, at: np.ndarray, n: int, canon, own, kind, joined) -> tuple[np.ndarray, np.ndarray]:
        """key and exact hash of the windows of n entries from each position; an entry that is joined to the one before it
        in a run adds nothing to the template but at the window's start."""
        key, slots, exact = (np.zeros(len(at), np.uint64) for _ in range(3))
        literal = np.zeros(len(at), np.int64)
        for k in range(n):
            p = at + k
            key = np.where(joined[p] & (k > 0), key, _roll(key, canon[p], _MULT))
            slots = np.where(kind[p] > 0, _roll(slots, own[p], _MULT2), slots)
            exact = _roll(exact, own[p], _MULT2)
            literal += kind[p] == 0
        return np.where(literal < self.literal, _roll(key, slots, _MULT), key), exact

    def windows(self, texts: list[str | None]):
        """text, first word, words, key, exact of every window, and per text its words, kinds and kinds with capitals."""
        split = [words_of(t) if t else ([], []) for t in texts]
        flat = [w for x, _ in split for w in x]
        z = np.zeros(0, np.int64)
        if not flat:
            return z, z, z, z.astype(np.uint64), z.astype(np.uint64), [(x, z, z) for x, _ in split]
        count = np.array([len(x) for x, _ in split], np.int64)
        n = self.numbers(flat)
        facts = np.array(self.facts, np.uint64)[n]
        canon, own, kind = facts[:, 0], facts[:, 1], facts[:, 2].astype(np.int64)
        capital = np.fromiter((c for _, x in split for c in x), bool, len(flat))
        owner = np.repeat(np.arange(len(split)), count)
        begin = np.cumsum(count) - count
        kinds = [kind, np.where(capital & (kind == WORDS), NAME, kind)]
        name = np.uint64(xxhash.xxh64_intdigest(_HOLDER[NAME]))
        out = []
        for family, kd in enumerate(kinds):
            cn = canon if family == 0 else np.where(kd != kind, name, canon)
            joined = np.zeros(len(flat), bool)
            joined[1:] = (owner[1:] == owner[:-1]) & (kd[1:] == kd[:-1]) & ((kd[1:] == NUMBER) | (kd[1:] == NAME))
            # windows of words; of the second family only those that hold a capitalised name
            at = np.flatnonzero(np.arange(len(flat)) + self.size <= (begin + count)[owner])
            if family:
                seen = np.append(0, np.cumsum(kd != kind))
                at = at[seen[at + self.size] > seen[at]]
            out.append((at, np.full(len(at), self.size), *self._hash(at, self.size, cn, own, kd, joined)))
            # windows of entries, where runs make them longer
            head = np.flatnonzero(~joined)
            if len(head) == len(flat):
                continue
            whole = np.add.reduceat(own, head)  # all words of an entry
            end = np.append(head[1:], len(flat))
            e = np.flatnonzero(np.arange(len(head)) + self.size <= len(head))
            last = end[e + self.size - 1]
            ok = (owner[head[e]] == owner[last - 1]) & (last - head[e] > self.size)
            if family:
                ok &= seen[last] > seen[head[e]]
            e, last = e[ok], last[ok]
            key, exact = self._hash(e, self.size, cn[head], whole, kd[head], np.zeros(len(head), bool))
            out.append((head[e], last - head[e], key, exact))
        at, words, key, exact = (np.concatenate(x) for x in zip(*out, strict=True))
        o = owner[at]
        per = [(x, kinds[0][b : b + n], kinds[1][b : b + n]) for (x, _), b, n in zip(split, begin.tolist(), count.tolist(), strict=True)]
        return o, at - begin[o], words, key, exact, per


def slots_of(words: list[str], kind) -> list[str]:
    """Texts of the placeholders, with their kind; runs of numbers and of names are one."""
    out, before = [], WORDS
    for w, k in zip(words, kind.tolist(), strict=True):
        if k and k == before and k != UNIT:
            out[-1] += " " + w
        elif k:
            out.append(f"{k} {w}")
        before = k
    return out


def _windows(size: int, literal: int, varying: np.ndarray, wanted: np.ndarray | None):
    """mapInArrow (id, text): id, position, words, key, exact, slots of every window, or of those whose key is among the
    wanted ones, which are sorted. Slots are read twice, without and with capitalised names."""

    def run(batches):
        t = Templates(size, literal, varying)
        for b in batches:
            owner, pos, words, key, exact, per = t.windows(b.column(1).to_pylist())
            if wanted is not None:
                at = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
                hit = wanted[at] == key
                owner, pos, words, key, exact = owner[hit], pos[hit], words[hit], key[hit], exact[hit]
            plain, capital = [], []
            for o, p, n in zip(owner.tolist(), pos.tolist(), words.tolist(), strict=True):
                w, k0, k1 = per[o]
                plain.append(slots_of(w[p : p + n], k0[p : p + n]))
                capital.append(slots_of(w[p : p + n], k1[p : p + n]))
            texts = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner)), pa.array(pos, pa.int32()), pa.array(key.view(np.int64)), pa.array(exact.view(np.int64)), pa.array(plain, texts), pa.array(capital, texts)],
                ["id", "position", "template", "exact", "slots", "named"],
            )

    return run


_SCHEMA = "id long, position int, template long, exact long, slots array<string>, named array<string>"


def _masked(size: int):
    """mapInArrow (id, text): hash of each window without each one of its words, and that word's hash."""

    def run(batches):
        for b in batches:
            out, words = [_NONE], [_NONE]
            for t in b.column(1).to_pylist():
                w = words_of(t)[0] if t else []
                h = np.array([xxhash.xxh64_intdigest(x) for x in w], np.uint64)
                at = np.arange(max(0, len(w) - size + 1))
                for skip in range(size):
                    acc = np.full(len(at), skip, np.uint64)
                    for k in range(size):
                        acc = acc if k == skip else _roll(acc, h[at + k], _MULT)
                    out.append(acc)
                    words.append(h[at + skip])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (out, words)], ["frame", "word"])

    return run


def varying_words(items: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of all words that differ between item windows that are otherwise equal: eight bytes a word of the
    items' vocabulary."""
    rows = items.mapInArrow(_masked(size), "frame long, word long").distinct()
    frames = rows.groupBy(F.col("frame").alias("f__")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    words = rows.join(frames, F.col("frame") == F.col("f__"), "left_semi").select("word").distinct().toArrow()
    return np.sort(words.column(0).to_numpy().astype(np.int64).view(np.uint64))


def _consistent(a: str, b: str) -> Column:
    """Every slot text of a stands for one slot text of b of the same kind, and the other way round."""
    pairs = F.array_distinct(F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y"))))
    n = lambda side: F.size(F.array_distinct(F.transform(pairs, lambda p: p[side])))
    kinds = F.forall(pairs, lambda p: F.substring(p["x"], 1, 1).eqNullSafe(F.substring(p["y"], 1, 1)))
    return (F.size(a) == F.size(b)) & (F.size(pairs) == n("x")) & (F.size(pairs) == n("y")) & kinds


def leaks(corpus: DataFrame, items: DataFrame, doc: str, item: str, text: str = "text", item_text: str = "text", window: int = 12, literal: int = 6, bound: int = 2_000_000) -> DataFrame:
    """doc_id, item_id, exact_windows, variant_windows: the documents that share a template window with an item.

    exact_windows counts the document's windows that hold the item's own words in all slots; variant_windows those that
    differ in slots only, consistently. Items and documents with fewer than `window` words, null and empty texts share
    none. Texts of any length are read whole; repeated rows of one id count once; empty tables give an empty result.
    Up to `bound` distinct item templates (16 MB) are sent to the tasks as a sorted array, so that only windows that
    join leave them; beyond it, all windows leave and the join is shuffled, with the same result. The words that vary
    between items are sent as hashes, all of them.
    """
    key = lambda t, i, x: t.select(F.col(i).cast("long").alias("id"), F.col(x).alias("text")).where(F.col("id").isNotNull() & F.col("text").isNotNull())
    varying = varying_words(key(items, item, item_text), window)
    own = key(items, item, item_text).mapInArrow(_windows(window, literal, varying, None), _SCHEMA)
    own = own.select(F.col("id").alias("item_id"), "template", F.col("exact").alias("i_exact"), F.col("slots").alias("i_slots"), F.col("named").alias("i_named")).distinct()
    few = own.select("template").distinct().limit(bound + 1)
    wanted = None
    if few.count() <= bound:
        got = few.toPandas()["template"].to_numpy()
        wanted = np.sort(got.astype(np.int64).view(np.uint64)) if len(got) else np.zeros(1, np.uint64)
    docs = key(corpus, doc, text).mapInArrow(_windows(window, literal, varying, wanted), _SCHEMA)
    hits = docs.join(own, "template")
    same = (F.col("exact") == F.col("i_exact")) & (F.col("slots") == F.col("i_slots"))
    hits = hits.withColumn("same", same).where(F.col("same") | _consistent("slots", "i_slots") | _consistent("named", "i_named"))
    per = hits.groupBy(F.col("id").alias("doc_id"), "item_id", "position").agg(F.max("same").alias("same"))
    return per.groupBy("doc_id", "item_id").agg(F.sum(F.col("same").cast("int")).alias("exact_windows"), F.sum((~F.col("same")).cast("int")).alias("variant_windows"))
