"""Garbled text from wrong character encodings: a hidden Markov model over the characters of a text.

States are "clean", one per encoding pair (bytes of one encoding read as another) and "lost" (replacement characters).
A state emits a character by what comes before it; characters of plain ASCII after one another look the same in all states
and are passed over. A stretch begins and ends at the cost of `enter` and `leave`, and goes on for free, so one garbled letter is
told by itself if it is odd enough, and a weakly garbled one by its neighbours. Both may happen at any character; between
two characters beyond ASCII of one word they cost `within` more, as words are mostly garbled as a whole.

Training needs no labels. The distinct words of the whole corpus are counted. A word whose inverse transform by some pair
is a clearly more frequent word, or which holds valid UTF-8 beyond ASCII, is not clean; the others train the clean state, and their
images under each pair train that pair's state. All of this stays distributed; only counts of character pairs reach the
driver. Characters that no pair can produce count as one, so there are fewer than a million pairs for each state.

The most likely path labels every character; each stretch of one label is a span, to which the inverse transform of its
pair is applied.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from massquarry.workspace import stage

# Encodings that text was written in, and those that it was wrongly read as.
WRITTEN = ("utf-8", "cp1252", "cp1250", "cp1251", "iso8859-2", "iso8859-5", "koi8-r", "cp866", "cp852", "cp850", "cp437", "mac-roman", "mac-cyrillic")
READ_AS = ("cp1252", "latin-1", "cp1250", "cp1251", "iso8859-2", "iso8859-5", "koi8-r", "cp866", "cp852", "cp850", "cp437", "mac-roman", "mac-cyrillic")

LOST = "�"
_DIGITS = re.compile(r"\d+")
_WORD = re.compile(r"[^ \t\r\n]+")
_RUN = re.compile(r"[^\x00-\x7f]+")


def _table(encoding: str) -> list[str]:
    """Characters of the 256 bytes; bytes without one are control characters of the same number, as lenient readers do."""
    out = []
    for i in range(256):
        try:
            out.append(bytes([i]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(i))
    return out


class Pair:
    """Bytes of `written` read as `read`, possibly twice."""

    def __init__(self, written: str, read: str, times: int = 1):
        self.written, self.read, self.times = written, read, times
        self.chars = _table(read)
        self.bytes = {c: i for i, c in reversed(list(enumerate(self.chars)))}
        self.name = f"{written}>{read}" + "*2" * (times == 2)
        self.back = None if written == "utf-8" else _table(written)
        self.forth = None if self.back is None else {c: i for i, c in reversed(list(enumerate(self.back)))}

    def garble(self, s: str) -> str | None:
        try:
            for _ in range(self.times):
                b = s.encode("utf-8", "surrogatepass") if self.forth is None else bytes(map(self.forth.__getitem__, s))
                s = "".join(map(self.chars.__getitem__, b))
        except KeyError:
            return None
        return s

    def restore(self, s: str) -> str | None:
        try:
            for _ in range(self.times):
                b = bytes(map(self.bytes.__getitem__, s))
                s = b.decode("utf-8") if self.back is None else "".join(map(self.back.__getitem__, b))
        except (KeyError, UnicodeDecodeError):
            return None
        return s


def pairs() -> list[Pair]:
    out = [Pair(w, r) for w in WRITTEN for r in READ_AS if w != r and {w, r} != {"latin-1", "cp1252"}]
    return out + [Pair("utf-8", r, 2) for r in ("cp1252", "latin-1", "cp1251", "cp1250", "cp437", "cp850", "mac-roman", "cp866")]


#: Characters beyond ASCII that a wrong reading can produce.
PRODUCED = frozenset(c for r in READ_AS for c in _table(r) if c > "\x7f") | {LOST}
#: Stands for all other characters beyond ASCII, which are clean wherever they are.
OTHER = "\u2fff"


def shape(text: str) -> str:
    """The text as the model sees it: numbers are all alike, and so are characters that no wrong reading produces."""
    return "".join(c if c <= "\x7f" or c in PRODUCED else OTHER for c in text).translate(_ZEROS)


_ZEROS = str.maketrans("123456789", "000000000")


def words_of(text: str) -> list[tuple[int, int]]:
    """Spans of the words that hold a character beyond ASCII; breaking spaces of other scripts end no word, as they may
    be halves of a garbled character."""
    return [m.span() for m in _WORD.finditer(text) if not m.group().isascii()]


def _pairs_in(s: str):
    """Characters after one another of which one at least is beyond ASCII."""
    return [(x, y) for x, y in zip(s, s[1:], strict=False) if x > "\x7f" or y > "\x7f"]


class Model:
    """Emissions of all states by character pairs, and transitions."""

    def __init__(self, counts: dict[tuple[int, str, str], int], enter: float = 7.0, leave: float = 2.0, within: float = 6.0, beta: float = 2.0):
        """counts: of (state, character, next character); state 0 is clean, 1 + i the i-th of pairs()."""
        self.enter, self.leave, self.within, self.beta = enter, leave, within, beta
        every = pairs()
        by: dict[int, Counter] = defaultdict(Counter)
        for (s, x, y), n in counts.items():
            by[s][x, y] += n
        tables, self.pairs, seen = [by[0]], [], set()
        for i, p in enumerate(every, 1):
            mark = frozenset(by[i].items())
            if mark and mark not in seen:  # pairs that the corpus does not tell apart are one
                seen.add(mark)
                self.pairs.append(p)
                tables.append(by[i])
        lost: Counter = Counter()
        for w in (LOST, f"a{LOST}a", f"a{LOST}{LOST}a", f"{LOST}a", f"a{LOST}"):
            lost.update(_pairs_in(f" {w} "))
        tables.append(lost)
        self.states = len(tables)
        self.labels = ["", *(p.name for p in self.pairs), "lost"]
        first, single, both = defaultdict(lambda: np.zeros(self.states)), defaultdict(lambda: np.zeros(self.states)), defaultdict(dict)
        for s, t in enumerate(tables):
            for (x, y), n in t.items():
                first[x][s] += n
                single[y][s] += n
                both[x, y][s] = n
        self.total = np.array([sum(t.values()) for t in tables], float)
        self.first, self.single, self.both = dict(first), dict(single), dict(both)

    def logs(self, x: str, y: str) -> np.ndarray:
        """Log probability of y after x in every state, less that of the clean state."""
        z = np.zeros(self.states)
        # a character that a state never emits has one millionth of its mass; of ASCII characters each state has some
        floor = 1e-3 if y <= "\x7f" else 1e-6
        one = (self.single.get(y, z) + floor) / (self.total + 1)
        n = z.copy()
        for s, k in self.both.get((x, y), {}).items():
            n[s] = k
        out = np.log((n + self.beta * one) / (self.first.get(x, z) + self.beta))
        return out - out[0]

    def path(self, e: np.ndarray, inside: list[bool]) -> np.ndarray:
        """Most likely states of the characters whose emissions, less the clean one's, are the rows of e; inside: whether
        a word goes on from the character before."""
        n, s = e.shape
        back = np.zeros((n, s), np.int32)
        v = e[0].copy()
        v[1:] -= self.enter
        for k in range(1, n):
            best = int(np.argmax(v[1:])) + 1
            more = self.within if inside[k] else 0.0
            if v[0] >= v[best] - self.leave - more:
                to_clean, from_clean = v[0], 0
            else:
                to_clean, from_clean = v[best] - self.leave - more, best
            stay = v[1:]
            come = to_clean - self.enter - more
            back[k, 1:] = np.where(stay >= come, np.arange(1, s), from_clean)
            back[k, 0] = from_clean
            v = np.concatenate([[to_clean], np.maximum(stay, come)]) + e[k]
        out = np.zeros(n, np.int64)
        out[-1] = int(np.argmax(v))
        for k in range(n - 1, 0, -1):
            out[k - 1] = back[k, out[k]]
        return out


class Labeller:
    """The model with a memory of words and character pairs, as one task uses it."""

    def __init__(self, model: Model):
        self.m, self.known, self.emissions = model, {}, {}

    def emission(self, x: str, y: str) -> np.ndarray:
        got = self.emissions.get((x, y))
        if got is None:
            got = self.emissions[x, y] = self.m.logs(x, y)
        return got

    def gain(self, word: str) -> np.ndarray:
        """What the best stretch within a word gains over the clean state, by state."""
        got = self.known.get(word)
        if got is None:
            run, got = np.zeros(self.m.states), np.zeros(self.m.states)
            for x, y in _pairs_in(f" {word} "):
                run = np.maximum(run, 0) + self.emission(x, y)
                got = np.maximum(got, run)
            if len(self.known) > 200_000:
                self.known = {}
            self.known[word] = got
        return got

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """begin, end, state of the garbled stretches, which begin and end beyond ASCII."""
        if not text or text.isascii():
            return []
        s = shape(text)
        total = np.zeros(self.m.states)
        for a, b in words_of(text):
            total += self.gain(s[a:b])
        if total.max() < self.m.enter:  # no path can leave the clean state
            return []
        s = f" {s} "
        # position i of the text is i + 1 here; the space at the end closes the text
        at = [i for i in range(1, len(s)) if s[i] > "\x7f" or s[i - 1] > "\x7f"]
        out: list[tuple[int, int, int]] = []
        for begin in range(0, len(at), _PART):
            part = at[begin : begin + _PART]
            inside = [s[i - 1] > "\x7f" and s[i] > " " for i in part]
            states = self.m.path(np.array([self.emission(s[i - 1], s[i]) for i in part]), inside)
            running = 0
            for i, state in zip(part, states.tolist(), strict=True):
                if s[i] <= "\x7f":  # ASCII within does not break a stretch
                    running = running if state == running else 0
                elif state and state == running:
                    out[-1] = (out[-1][0], i, state)
                else:
                    running = state
                    if state:
                        out.append((i - 1, i, state))
        return out

    def repair(self, text: str, spans) -> tuple[str, int]:
        """The text with each span restored where its pair's inverse applies, and the spans that stay as they are."""
        out, at, failed = [], 0, 0
        for a, b, s in spans:
            out.append(text[at:a])
            piece = text[a:b]
            r, whole = (piece, False) if s == self.m.states - 1 else self._inverse(piece, self.m.pairs[s - 1])
            failed += not whole or LOST in r
            out.append(r)
            at = b
        out.append(text[at:])
        return "".join(out), failed

    @staticmethod
    def _inverse(piece: str, pair: Pair) -> tuple[str, bool]:
        """The piece restored, as a whole or run by run, and whether no garbled run is left. A single character is no
        garbled UTF-8, so one that stands alone in a stretch is left as it is."""
        r = pair.restore(piece)
        if r is not None:
            return r, True
        runs = re.split(r"([\x00-\x7f]+)", piece)
        back = [x if x.isascii() else pair.restore(x) for x in runs]
        left = any(y is None and (len(x) > 1 or pair.back is not None) for x, y in zip(runs, back, strict=True))
        some = any(y is not None and y != x for x, y in zip(runs, back, strict=True))
        return "".join(x if y is None else y for x, y in zip(runs, back, strict=True)), some and not left


#: Characters of one text that are labelled at a time; their states take 1 MB per thousand.
_PART = 20_000


def _count(batches):
    """mapInArrow (text): the distinct words of each batch with their counts."""
    for b in batches:
        c: Counter = Counter()
        for t in b.column(0).to_pylist():
            if t and not t.isascii():
                c.update(t[i:j].translate(_ZEROS) for i, j in words_of(t))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["word", "n"])


def _bigram_rows(states: list[int], counts: list[Counter]) -> pa.RecordBatch:
    rows = [(s, x, y, n) for s, c in zip(states, counts, strict=True) for (x, y), n in c.items()]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64())], ["state", "x", "y", "n"])


_BIGRAMS = "state int, x string, y string, n long"


def _plain(view):
    """mapInArrow (word, n): character pairs of all words as seen through `view`, as state 0."""

    def run(batches):
        for b in batches:
            c: Counter = Counter()
            for w, n in zip(*(x.to_pylist() for x in b.columns), strict=True):
                for p in _pairs_in(f" {view(w)} "):
                    c[p] += n
            yield _bigram_rows([0], [c])

    return run


def _readings(seen: dict[tuple[str, str], int]):
    """mapInArrow (word, n): other readings of each word. A null one says that the word is not clean by itself. A reading
    can only be a word that is four times as frequent if all its character pairs (seen) are."""

    def run(batches):
        every = pairs()
        domains = [frozenset(p.bytes) for p in every]
        utf8 = [k for k, p in enumerate(every) if p.back is None]
        others = [k for k, p in enumerate(every) if p.back is not None]
        characters = {y for _, y in seen}
        known: dict[str, list[str | None]] = {}
        odd = lambda r: any("\x80" <= c <= "\x9f" for c in r)

        def restored(run: str) -> list[str | None]:
            got = known.get(run)
            if got is None:
                if len(known) > 100_000:
                    known.clear()
                chars = frozenset(run)
                got = known[run] = [p.restore(run) if chars <= d else None for p, d in zip(every, domains, strict=True)]
            return got

        few: dict[str, set] = {}

        def alike(run: str, back: list[str | None]) -> set:
            if run not in few:
                if len(few) > 100_000:
                    few.clear()
                few[run] = {(back[k],) for k in others}
            return few[run]

        def not_clean(back: list[list[str | None]]) -> bool:
            for k in utf8:
                now = [b[k] for b in back]
                fine = [r is not None and not odd(r) for r in now]
                # a part of a word may be garbled: UTF-8 of characters that the corpus holds elsewhere
                if all(fine) or any(ok and characters.issuperset(shape(r)) for ok, r in zip(fine, now, strict=True)):
                    return True
            return False

        for b in batches:
            words, ns, readings = [], [], []
            for w, n in zip(*(x.to_pylist() for x in b.columns), strict=True):
                found: set[str | None] = set()
                runs = _RUN.findall(w)
                back = [restored(x) for x in runs]
                if LOST in w or odd(w) or not_clean(back):
                    found = {None}
                else:
                    between = _RUN.split(w)
                    for now in alike(runs[0], back[0]) if len(runs) == 1 else {tuple(x[k] for x in back) for k in others}:
                        if None in now or now == tuple(runs) or not characters.issuperset(shape("".join(now))):
                            continue
                        r = "".join(x for y in zip(between, [*now, ""], strict=True) for x in y)
                        if all(seen.get(x, 0) > 4 * n for x in _pairs_in(f" {shape(r)} ")):
                            found.add(r)
                for r in found:
                    words.append(w)
                    ns.append(n)
                    readings.append(r)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(ns, pa.int64()), pa.array(readings, pa.string())], ["word", "n", "reading"])

    return run


def _images(batches):
    """mapInArrow (state, x, y, n), the character pairs of clean words: those of each state. Each character is garbled by
    itself, so a pair's image is the last character of x's image before the first of y's, and what lies within y's."""
    every = pairs()
    known: list[dict[str, str | None]] = [{} for _ in every]

    def image(k: int, c: str) -> str | None:
        if c not in known[k]:
            g = every[k].garble(c)
            known[k][c] = None if g is None else shape(g)
        return known[k][c]

    for b in batches:
        counts = [Counter() for _ in range(len(every) + 1)]
        for x, y, n in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True):
            counts[0][shape(x), shape(y)] += n
            for k in range(len(every)):
                gx, gy = image(k, x), image(k, y)
                if gx is None or gy is None or (gx, gy) == (shape(x), shape(y)):  # what a pair leaves as it is tells nothing
                    continue
                for p in _pairs_in(gx[-1] + gy):
                    counts[k + 1][p] += n
        yield _bigram_rows(list(range(len(counts))), counts)


def train(df: DataFrame, text: str) -> Model:
    """A model of the words of all texts."""
    words = stage(df.select(F.col(text)).mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    # a row is little to read and much to work on, so the words go to all cores whatever their size
    words = words.repartition(df.sparkSession.sparkContext.defaultParallelism, "word")
    add = lambda t: t.groupBy("state", "x", "y").agg(F.sum("n").alias("n"))
    # fewer than a million pairs: some 600 characters that a wrong reading can produce, one for the others, and ASCII
    seen = {(r.x, r.y): r.n for r in add(words.mapInArrow(_plain(shape), _BIGRAMS)).collect()}
    other = words.mapInArrow(_readings(seen), "word string, n long, reading string")
    known = words.select(F.col("word").alias("w__"), F.col("n").alias("n__"))
    odd = other.join(known, F.col("reading") == F.col("w__"), "left").where(F.col("reading").isNull() | (F.col("n__") > 4 * F.col("n"))).select(F.col("word").alias("odd__")).distinct()
    clean = words.join(odd, F.col("word") == F.col("odd__"), "left_anti")
    own = add(clean.mapInArrow(_plain(str), _BIGRAMS))
    # 256 characters of a reading and ASCII before and after them bound each state
    rows = add(own.mapInArrow(_images, _BIGRAMS)).collect()
    return Model({(r.state, r.x, r.y): r.n for r in rows})


def _repairs(model: Model):
    def run(batches):
        lab = Labeller(model)
        for b in batches:
            ids, out = b.column(0), []
            for k, t in enumerate(b.column(1).to_pylist()):
                spans = lab.spans(t)
                if spans:
                    fixed, failed = lab.repair(t, spans)
                    out.append((k, fixed, len(spans), failed, sorted({lab.m.labels[s] for *_, s in spans})))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.list_(pa.string()))],
                ["doc_id", "restored", "spans", "unrestored", "encodings"],
            )

    return run


def repair(df: DataFrame, id_col: str, text: str, model: Model | None = None) -> DataFrame:
    """doc_id, restored, spans, unrestored, encodings: one row per text with garbled characters.

    restored is the text with every span put right that can be; unrestored counts the others, among them all with
    replacement characters. Null, empty and plain ASCII texts give no row; rows of one id are handled each by itself;
    long texts are read whole; extra columns are ignored; an empty table gives an empty result.
    """
    model = model or train(df, text)
    return df.select(F.col(id_col).cast("long"), F.col(text)).mapInArrow(_repairs(model), "doc_id long, restored string, spans int, unrestored int, encodings array<string>")
