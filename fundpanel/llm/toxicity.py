"""Toxicity by noisy-channel deobfuscation.

Words may be written with look-alike characters (1d10t), spread out (s t u p i d,
s-t-u-p-i-d) or with repeated letters (stuuupid). Each word becomes a lattice of what
its writer may have meant: every character stands for itself or, at a price, for the
letters it looks like, runs of a letter may be shorter, marks at its edges may go, and separators, and the blanks
between single characters, may be nothing or the end of a word: one written word may hold
several.
Viterbi search finds the likeliest reading under a character trigram model counted over
all texts of the corpus. The restored words are then scored.

The score rests on features of restored words: the word itself and its beginnings of 4
to 6 letters, so that unseen endings of a seen stem count. From labelled texts Spark
counts in how many toxic and clean ones each feature stands. A feature is kept when more
than KEEP of its texts are toxic (KEEP_START for beginnings, which speak for words that
no text had), and so many more than of all labelled texts that chance
gives it with odds below DOUBT over all features together: n * KL(share, base share) >=
ln(features / DOUBT). The FEATURES strongest (by texts, then name) are kept. Copies of
one toxic text would make all its words look toxic, so of labelled texts of a kind that
agree in the smallest hash of their 3-word shingles, or in the largest, one is counted.
A text's score is the highest
share among its features, 0 where it has none. As trigrams alone may join words wrongly
(a s t u p i d), a feature also counts where it begins at any place where a written word
may have a limit: after a separator, or at a character that stands alone.

Defined results: null and empty texts have no feature. Labels that are null, or of no
document, are unused; without labels all scores are 0. Equal texts, and so repeated rows,
get equal scores. Texts and words of any length are read whole. An empty table gives none.
Columns of any name stay as they are: added ones take a name that is free.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Callable, Collection, Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, partial
from typing import TypeVar

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundpanel.llm.common import fresh, in_sketch, key_sketch, staged, tidy
from fundpanel.llm.ngram_join import shingles

#: Look-alikes and the letters they may stand for; fixed values.
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i", "µ": "u", "*": "aeiou", "#": "aeiou"}
SEPARATORS = set(".-_*~'`´,:;/\\·•​")
KEEP, KEEP_START, DOUBT, FEATURES, REJECT = 0.5, 0.95, 0.01, 50_000, 0.7
#: Prices in nats: a look-alike, a shorter run, a dropped separator, a character that
#: stays though it is no letter.
LOOK, SHORT, DROP, ODD = 1.0, 1.0, 0.5, 6.0
#: Characters of the model: white space, anything else, then letters by code point.
SYMBOLS = 64
#: Longer words are read like all, but not cached.
LONG = 100
#: Stands for a place where a word may begin or end.
OPEN = "\0"
T = TypeVar("T")

_TWICE, _LETTERS_ALIKE = re.compile(r"(.)\1", re.S), {c for c in LOOKS if c.isalpha()}
#: Where a word may end within a written one.
_BREAK = re.compile(r"[\W_]")
_GAP = re.compile(f"[ {re.escape(''.join(sorted(SEPARATORS)))}]")
_LOOK = "".join(c for c in LOOKS if _BREAK.match(c))
#: The commonest of what can be no letter at the edges of a word.
MARKS = "".join(c for c in map(chr, range(0x21, 0x80)) if _BREAK.match(c) and c not in LOOKS)


def symbol(c: str) -> int:
    """Letters of the Latin blocks have symbols of their own as far as there are."""
    if "a" <= c <= "z":
        return ord(c) - 95
    if "ß" <= c <= "ÿ":
        return 28 + ord(c) - 0xDF
    return 1


_CODES = np.ones(0x250, np.uint8)
for _c in range(0x250):
    _CODES[_c] = symbol(chr(_c).lower()[:1])
for _c in (0x20, *range(0x09, 0x0E), 0x85, 0xA0):
    _CODES[_c] = 0
#: Symbols of single characters within words; all others have 1.
_SYMBOL = {chr(c): s for c in range(0x100) if (s := symbol(chr(c))) != 1} | {" ": 0}


def trigram_counts(text: str) -> np.ndarray:
    """Codes of all trigrams of a text, with white space before and after it."""
    if text.isascii():
        s = _CODES[np.frombuffer(f" {text} ".encode(), np.uint8)].astype(np.int32)
    else:
        points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        s = _CODES[np.where(points < len(_CODES), points, 0x21)].astype(np.int32)
    return (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]


@dataclass
class Model:
    """All that scoring needs: at most SYMBOLS**3 and FEATURES numbers."""

    cost: np.ndarray
    shares: dict[str, float] = field(default_factory=dict)

    @cached_property
    def lengths(self) -> list[int]:
        """Lengths of the features that are whole words."""
        return sorted({len(f) for f in self.shares if not f.endswith("…")})


def language_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Cost in nats of a symbol after two others, from the trigrams of all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(SYMBOLS**3, np.int64)
            for t in batch.column(0):
                if t.as_py():
                    codes = trigram_counts(t.as_py())
                    total += np.bincount(codes, minlength=SYMBOLS**3) if len(codes) > 20_000 else 0
                    if len(codes) <= 20_000:
                        np.add.at(total, codes, 1)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["code", "n"])

    counts = np.zeros(SYMBOLS**3)
    for code, n in docs.select(text).mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        counts[code] = n  # SYMBOLS**3 rows at most
    counts = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two = counts.sum(axis=0)
    back = (two + 0.5) / (two + 0.5).sum(axis=1, keepdims=True)
    three = (counts + 5 * back[None]) / (counts.sum(axis=2, keepdims=True) + 5)
    return -np.log(three).astype(np.float64)


def edges(word: str, keep: str | dict = "") -> tuple[int, int]:
    """Where a word begins and ends without the marks at its edges; those to keep stop it."""
    a, b = 0, len(word)
    while a < b and word[a] not in keep and _BREAK.match(word[a]):
        a += 1
    while a < b and word[b - 1] not in keep and _BREAK.match(word[b - 1]):
        b -= 1
    return a, b


def lattice(word: str, limits: bool = False) -> list[list[tuple[str, int, float]]]:
    """For each position: (letters written out, positions passed, price). What is dropped
    may end a word (a blank is written out); with limits, words go on over it and OPEN is
    written out, and look-alikes at the edges are read with OPEN beside them, in place of
    dropped."""
    out, n = [], len(word)
    gap, odd = [0] * (n + 1), [False] * (n + 1)  # separators and blanks from here on; whether not only blanks
    for i in range(n - 1, -1, -1) if _GAP.search(word) else ():
        if word[i] == " " or word[i] in SEPARATORS:
            gap[i], odd[i] = gap[i + 1] + 1, word[i] != " " or odd[i + 1]
    spaced, last = " " in word, ""
    lead, tail = edges(word)
    for i, (c, after) in enumerate(zip(word, [*word[1:], ""], strict=True)):
        if c != after and c not in LOOKS and c.isalpha() and not (spaced and gap[i + 1]):
            out.append([(c, 1, 0.0)])  # a letter by itself has one reading
            last = c
            continue
        ways: list[tuple[str, int, float]] = [] if c == " " else [(c, 1, 0.0 if c.isalpha() else ODD)]
        for letter in LOOKS.get(c, ""):
            ways.append((letter, 1, LOOK))
        if not lead <= i < tail and not (limits and c in LOOKS):
            ways += [("", k, 0.0) for k in {1, (lead if i < lead else n) - i}]
        elif lead <= i < tail and (gap[i] or _BREAK.match(c)):
            price = 0.0 if gap[i] and not odd[i] else DROP
            for k in {1, gap[i] or 1}:
                ways += [(OPEN, k, price)] if limits else [("", k, price), (" ", k, price)] if gap[i] else [(" ", k, price)]
        if c != last and (c.isalpha() or c in LOOKS):
            run, same, at = 1, 1, i + 1
            while at < n:
                at += gap[at] if spaced and word[at] != c else 0
                if at == n or word[at] != c:
                    break
                at, same = at + 1, same + 1
                run = at - i
            for letter in [c, *LOOKS.get(c, "")] if same > 1 else []:
                look = 0.0 if c.isalpha() else LOOK
                ways.append((letter, run, look + SHORT))
                if same > 2:
                    ways.append((letter * 2, run, look + SHORT))
        if not (spaced and gap[i]) or c in LOOKS:
            last = c
        if limits and c in LOOKS and not lead <= i < tail:
            ways = [(x + OPEN if i < lead else OPEN + x, k, price) for x, k, price in ways]
        out.append(ways)
    return out


def restore(word: str, cost: list[float], limits: bool = False) -> str:
    """The likeliest reading of a lower-case word, or of single characters with blanks
    between them: Viterbi over positions of the lattice, with the last two symbols as
    state. The words of a reading have blanks between them; with limits it is one word,
    with OPEN where words may begin and end. cost: by code of the trigram."""
    if word.isalpha() and not _TWICE.search(word) and _LETTERS_ALIKE.isdisjoint(word):
        return word
    ways = lattice(word, limits)
    done: list[str] = []  # what is settled, as only one state is left
    best: list[dict[tuple[int, int], tuple[float, tuple | None]] | None] = [{} for _ in range(len(word) + 1)]
    best[0][(0, 0)] = (0.0, None)
    reached = i = 0
    while i < len(word):
        here = ways[i]
        if len(best[i]) == 1 and reached == i:
            (state, (paid, said)), = best[i].items()
            done.append(_said(said))
            best[i] = {state: (paid, None)}
            to = i
            while to < len(word) and len(ways[to]) == 1 and ways[to][0][0].isalpha():
                to += 1  # what all readings go through costs all of them the same
            if to > i:
                done.append(word[i:to])
                x, y = [*state, *(_SYMBOL.get(c, 1) for c in word[max(i, to - 2):to])][-2:]
                best[i], best[to], reached, i = None, {(x, y): (paid, None)}, to, to
                continue
        if not best[i]:  # no reading comes by
            i += 1
            continue
        ahead = [(letters, [_SYMBOL.get(c, 1) for c in letters if c != OPEN], best[i + step], price) for letters, step, price in here]
        reached = max(reached, *(i + step for _, step, _ in here))
        for (a, b), (paid, said) in best[i].items():
            for letters, symbols, there, price in ahead:
                x, y, total = a, b, paid + price
                for z in symbols:
                    total += cost[(x * SYMBOLS + y) * SYMBOLS + z]
                    x, y = y, z
                state = there.get((x, y))
                if state is None or total < state[0]:
                    there[x, y] = (total, (said, letters) if letters else said)
        best[i] = None
        i += 1
    found = [(paid + cost[(a * SYMBOLS + b) * SYMBOLS], _said(said)) for (a, b), (paid, said) in best[-1].items()]
    return "".join(done) + min(found)[1]


def _said(letters: tuple | None) -> str:
    """What a chain of (before, letters) spells."""
    out = []
    while letters:
        letters, last = letters
        out.append(last)
    return "".join(reversed(out))


_ALONE = rf"(?:[^\W_]|(?<!\S)[{re.escape(_LOOK)}](?!\S))"
#: With the character before it, so that the search skips from word to word.
_SPREAD = re.compile(rf"[\W_]((?:{_ALONE}[\W_]+)+{_ALONE})(?![^\W_])")


def spread_words(text: str) -> set[str]:
    """Characters that stand alone, two or more in a row, with a blank between them. Where
    words begin and end in it is for the lattice to say."""
    return {" ".join(c for c in run if c.isalnum() or c in LOOKS) for run in _SPREAD.findall(f" {text}")}


def _skeletons() -> dict[str, str]:
    """Characters to what no reading of a lattice changes: characters that may stand for
    each other have one symbol."""
    root = {c: c for c in [*LOOKS, *"".join(LOOKS.values())]}

    def find(c: str) -> str:
        while root[c] != c:
            c = root[c]
        return c

    for c, letters in LOOKS.items():
        for x in letters:
            root[find(x)] = find(c)
    return {c: find(c) for c in root}


_SYMBOLS, _RUN = _skeletons(), re.compile(r"(.)\1+", re.S)
#: Separators have none, but for those that are look-alikes as well.
_SKELETON = {ord(c): s for c, s in _SYMBOLS.items()} | {ord(c): None for c in SEPARATORS - set(LOOKS)}


def skeleton(word: str) -> str:
    """The same for all readings of a word that drop no look-alike; that of a beginning
    begins the word's."""
    return _RUN.sub(r"\1", word.translate(_SKELETON))


class Recent:
    """What was made of words, for at most `keep` of them: those met since the last change
    of the two tables, and those met before it."""

    def __init__(self, keep: int) -> None:
        self.keep, self.new, self.old = keep, {}, {}

    def of(self, words: Collection[str], make: Callable[[str], T]) -> list[T]:
        found = list(map(self.new.get, words))
        if None in found:
            found = [self._learn(w, make) if f is None else f for w, f in zip(words, found, strict=True)]
        return found

    def _learn(self, w: str, make: Callable[[str], T]) -> T:
        got = self.old.get(w)
        if got is None:
            got = make(w)
        if len(w) <= LONG:
            if len(self.new) >= self.keep // 2:
                self.new, self.old = {}, self.new
            self.new[w] = got
        return got


class Leads(dict):
    """Whether a word of letters that begins with these two may begin with a wanted
    feature; filled as it is asked, for at most `keep` of them."""

    def __init__(self, starts: set[str] | None, ways_in: set[str], keep: int) -> None:
        self.starts, self.ways_in, self.keep = starts, ways_in, keep

    def __missing__(self, two: str) -> bool:
        x, y = _SYMBOLS.get(two[0], two[0]), _SYMBOLS.get(two[-1], two[-1])
        got = self.starts is None or x in self.ways_in and (y == x or x + y in self.ways_in or x in self.starts)
        if len(self) >= self.keep:
            self.clear()
        self[two] = got
        return got


class Restorer:
    """Restored words with a bounded cache, which drops what was not met lately. Where only
    some features matter, what no reading can give a word with such a feature is left as it
    is: its skeletons tell."""

    def __init__(self, cost: np.ndarray, wanted: Iterable[str] | None = None, keep: int = 300_000) -> None:
        self.cost, self.keep, self.cache = cost.ravel().tolist(), keep, Recent(keep)
        self.scores, self.model = Recent(keep), None  # scores of words under one model
        self.starts = None if wanted is None else {skeleton(f.rstrip("…")) for f in wanted}
        self.lengths = sorted({len(s) for s in self.starts or ()})
        self.ways_in = {s[:k] for s in self.starts or () for k in range(len(s) + 1)}
        self.leads = Leads(self.starts, self.ways_in, keep)

    def matters(self, word: str) -> bool:
        """Whether a word of a reading may begin with a wanted feature. What is no letter
        may be dropped, end a word or be read; skeletons that lead nowhere are left out."""
        if self.starts is None:
            return True
        if word.isalpha():
            if not self.leads[word[:2]]:
                return False
            own = skeleton(word)
            return any(own[:k] in self.starts for k in self.lengths)
        reached, at = {""}, 0
        while at < len(word):
            c = word[at]
            at += 1
            if c == " " or c in SEPARATORS and c not in LOOKS:
                reached.add("")
                continue
            limit = _BREAK.match(c)
            if limit:
                reached.add("")
            x = _SYMBOLS.get(c, c)
            ahead = {s if s.endswith(x) else s + x for s in reached} & self.ways_in
            if not ahead.isdisjoint(self.starts):
                return True
            if limit:
                ahead |= reached
            reached = ahead
            if not reached:
                end = _BREAK.search(word, at)
                if end is None:
                    return False
                at = end.start()
        return False

    def core(self, w: str) -> tuple[str, bool]:
        """A word without what can be no letter at its edges, and whether it is to be decoded."""
        core = w if w.isalpha() else w[slice(*edges(w, LOOKS))]
        return core, core != "" and self.matters(core)

    def read(self, w: str) -> str:
        core, decode = self.core(w)
        return restore(core, self.cost) if decode else core

    def read_open(self, w: str) -> str:
        """Where a word has limits within, the reading with OPEN at them."""
        core, decode = self.core(w)
        return restore(core, self.cost, True) if decode and _BREAK.search(core) else ""

    @staticmethod
    def written(text: str | None) -> set[str]:
        """Distinct words as they are written, without marks at their edges, which no
        reading keeps."""
        text = (text or "").lower()
        return ({w.strip(MARKS) for w in set(text.split())} | spread_words(text)) - {""}

    def words(self, text: str | None) -> set[str]:
        """Distinct restored words of a whole text."""
        return set(" ".join(self.cache.of(self.written(text), self.read)).split())


def features(words: set[str]) -> set[str]:
    return words.union(*({w[:k] + "…" for w in words if len(w) > k} for k in (4, 5, 6)))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic") -> Model:
    """labels: the rows that may be learned from. The features of labelled texts are
    counted by Spark; the FEATURES strongest come to the driver."""
    cost = language_model(docs, text)
    held = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_toxic")).filter("_key is not null and _toxic in (0, 1)")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(cost)
        for batch in batches:
            seen, toxic = Counter(), Counter()
            for t, y in zip(batch.column("_text").to_pylist(), batch.column("_toxic").to_pylist(), strict=True):
                own = features(restorer.words(t)) | {""}
                seen.update(own)
                if y:
                    toxic.update(own)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64()), pa.array([toxic[f] for f in seen], pa.int64())], ["feature", "n", "toxic"])

    def ends(texts: pd.Series) -> pd.DataFrame:
        sets = [shingles(t, 3) for t in texts]
        return pd.DataFrame([(int(x[0]), int(x[-1])) if len(x) else (0, 0) for x in sets], columns=["lo", "hi"])

    marks = (docs.select(F.col(key).alias("_key"), F.pandas_udf(ends, "lo long, hi long")(F.col(text)).alias("e")).join(held, "_key")
             .groupBy("_toxic", "e.lo").agg(F.min(F.struct("e.hi", "_key")).alias("m"))
             .groupBy("_toxic", "m.hi").agg(F.min("m._key").alias("_key")).select("_key", "_toxic"))
    marks = staged(marks, "labelled")
    sketch = key_sketch(marks.select(F.xxhash64("_key").alias("h")), "h")

    def labelled(hashes: pd.Series) -> pd.Series:
        return pd.Series(in_sketch(np.frombuffer(sketch, np.uint32), hashes.to_numpy(np.int64)))

    # only texts that may have a label are moved
    own = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).filter(F.pandas_udf(labelled, "boolean")(F.xxhash64("_key")))
    rows = own.join(marks, "_key").select("_text", "_toxic")
    counts = staged(rows.mapInArrow(count, "feature string, n long, toxic long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")), "features")
    base = counts.filter("feature = ''").collect()  # stands in every text
    if not base or not 0 < base[0]["toxic"] < base[0]["n"]:
        return Model(cost)
    b = base[0]["toxic"] / base[0]["n"]
    least = math.log(counts.count() / DOUBT)
    p = F.least(F.col("toxic") / F.col("n"), F.lit(1 - 1e-9))
    gain = F.col("n") * (p * F.log(p / b) + (1 - p) * F.log((1 - p) / (1 - b)))
    enough = F.when(F.col("feature").endswith("…"), F.lit(KEEP_START)).otherwise(F.lit(KEEP))
    strong = counts.filter((p > enough) & (gain >= least)).orderBy(F.desc("n"), "feature").limit(FEATURES).collect()
    return Model(cost, {r["feature"]: (r["toxic"] + 0.5) / (r["n"] + 1) for r in strong})


def score_word(model: Model, restorer: Restorer, written: str) -> float:
    core, decode = restorer.core(written)
    if not decode:  # no reading has a feature, nor has the word as it is written
        return 0.0
    shares = model.shares
    best = 0.0
    for w in restore(core, restorer.cost).split():
        for f in (w, f"{w[:4]}…", f"{w[:5]}…", f"{w[:6]}…"):
            if len(w) >= len(f):
                best = max(best, shares.get(f, 0.0))
    if _BREAK.search(core):
        parts = restore(core, restorer.cost, True).split(OPEN)
        limits = {0, *itertools.accumulate(map(len, parts))}
        w = "".join(parts)
        for i in limits:
            for k in model.lengths:
                if i + k in limits:
                    best = max(best, shares.get(w[i:i + k], 0.0))
            for k in (4, 5, 6):
                if i + k < len(w):
                    best = max(best, shares.get(f"{w[i:i + k]}…", 0.0))
    return best


def score_text(model: Model, restorer: Restorer, text: str | None) -> float:
    if restorer.model is not model:
        restorer.scores, restorer.model = Recent(restorer.keep), model
    leads = restorer.leads
    words = [w for w in restorer.written(text) if leads[w[:2]] or not w.isalpha()]  # what leads nowhere scores 0
    return max(restorer.scores.of(words, partial(score_word, model, restorer)), default=0.0)


def scored(model: Model, text: Column) -> Column:
    """Score of a text column, 0 to 1."""
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restorer = Restorer(model.cost, model.shares)
        for texts in batches:
            yield pd.Series([score_text(model, restorer, t) for t in texts], dtype="float64")

    return F.pandas_udf(of, "double").asNondeterministic()(text)


@tidy
def clean_documents(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", reject: float = REJECT) -> DataFrame:
    """Documents whose score is below `reject`, with the columns they came with."""
    score = fresh(docs, "toxicity")
    return docs.withColumn(score, scored(fit(docs, labels, text, key), F.col(text))).filter(F.col(score) < reject).drop(score)
