"""Quality rules with risk-controlled thresholds.

Each rule measures a text; a cutoff on the measure rejects. Cutoffs are chosen per
stratum on labelled documents so that, with confidence 1 - delta over all strata and
rules together, at most a share alpha of a stratum's good documents is rejected:

* a rule may spend alpha / rules, and its confidence is delta / (rules * strata)
  (Bonferroni over the pairs);
* within a pair, the cutoffs of a fixed grid are tested from the most lenient on, each
  by the exact (Clopper-Pearson) upper bound of a binomial share; testing stops at the
  first failure (fixed-sequence testing, which needs no further correction);
* of the cutoffs that passed, the one with the largest number of bad documents caught
  less `care` times the good ones lost is taken, the most lenient of equals.

A stratum without enough good labels to pass a single test gets no cutoff.

Defined results: a null text counts as empty; it has no words and fails the base rule.
A null stratum is the stratum `und`. Labels without a document, or null, are unused.
Repeated rows are judged alike (and count as often as they stand in the labels). Texts of
any length are measured whole. An empty table gives none. Columns of any name stay as they
are: added ones take a name that is free.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundpanel.llm.common import fresh, staged, tidy

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_bars long"
RULES = ("symbols", "repeats", "dup_lines", "bars")
GRID = 200
ALPHA, DELTA, CARE = 0.04, 0.05, 5.0

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_HAS_WORD = re.compile(rb"[^\x20\x09-\x0d]")


def measure(text: str | None) -> tuple[int, ...]:
    """The base numbers of one whole text, in the order of MEASURES."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly \x20 and \x09-\x0D
    n = len(words)
    data = np.frombuffer(raw, np.uint8)
    chars = int(((data & 0xC0) != 0x80).sum() - _SPACE[data].sum())
    symbols = int(_SYMBOL[data].sum())
    lines = [x for x in raw.split(b"\n") if _HAS_WORD.search(x)]
    repeated = 0
    if n >= 3:
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
        pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1].astype(np.int64)
        code = pairs[:-1] * len(known) + ids[2:]
        _, at, counts = np.unique(code, return_inverse=True, return_counts=True)
        twice = counts[at] >= 2
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k:n - 2 + k] |= twice
        repeated = int(covered.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines), raw.count(b"|")


def measured(text: Column) -> Column:
    """Struct of MEASURES of a text column."""
    names = [x.split()[0] for x in MEASURES.split(", ")]

    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=names).astype("int64")

    # not deterministic by name only, so that a filter on it does not compute it twice
    return F.pandas_udf(of, MEASURES).asNondeterministic()(text)


def rule_values(m: str) -> dict[str, Column]:
    """Rule to a share from 0 to 1 of the struct column m; high is bad."""
    share = lambda a, b: F.least(F.lit(1.0), a / F.greatest(b, F.lit(1)))
    f = lambda name: F.col(f"{m}.{name}").cast("double")
    return {
        "symbols": share(f("n_symbols"), f("word_chars")),
        "repeats": share(f("n_repeat_words"), f("n_words")),
        "dup_lines": share(f("n_dup_lines"), f("n_lines")),
        "bars": share(f("n_bars"), f("n_words")),
    }


def base_failed(m: str) -> Column:
    return (F.col(f"{m}.n_words") < 50) | (F.col(f"{m}.n_repeat_words") * 100 > F.col(f"{m}.n_words") * 50)


def upper_bound(failures: int, n: int, confidence: float) -> float:
    """Clopper-Pearson upper bound of a binomial share: the p at which so few failures
    have probability 1 - confidence, found by bisection on the exact tail."""
    if n == 0 or failures >= n:
        return 1.0

    def tail(p: float) -> float:
        logs = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
                for k in range(failures + 1)]
        top = max(logs)
        return math.exp(top) * sum(math.exp(x - top) for x in logs)

    low, high = failures / n, 1.0 - 1e-12
    for _ in range(60):
        mid = (low + high) / 2
        if mid <= 0 or tail(mid) > 1 - confidence:
            low = mid
        else:
            high = mid
    return high


def choose_cutoff(good: np.ndarray, bad: np.ndarray, risk: float, delta: float, care: float = CARE) -> int | None:
    """Grid counts of good and bad labels (index: floor(share * GRID)) to the first grid
    step that is rejected, or None."""
    total, best = int(good.sum()), None
    most = int(risk * total) + 1  # more failures than that cannot pass
    for k in range(len(good) - 1, 0, -1):
        lost = int(good[k:].sum())
        if lost > most or upper_bound(lost, total, 1 - delta) > risk:
            break
        gain = float(bad[k:].sum()) - care * lost
        if gain > 0 and (best is None or gain > best[0]):
            best = (gain, k)
    return None if best is None else best[1]


def measures(docs: DataFrame, text: str = "text", stratum: str = "lang", key: str = "doc_id") -> DataFrame:
    """(key, stratum, measures) of every document; narrow, so it is staged and read twice."""
    return docs.select(F.col(key).alias("_key"), F.coalesce(F.col(stratum).cast("string"), F.lit("und")).alias("_stratum"),
                       measured(F.col(text)).alias("_m"))


def fit(rows: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
        alpha: float = ALPHA, delta: float = DELTA) -> dict[tuple[str, str], int]:
    """rows: of `measures`. (stratum, rule) to cutoff. The labelled documents are counted
    on a grid by Spark; strata * rules * grid numbers come to the driver."""
    held = (labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_good"))
            .filter("_key is not null and _good in (0, 1)"))
    values = rule_values("_m")
    binned = rows.filter(~base_failed("_m")).join(held, "_key").select("_stratum", "_good", F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.floor(v * GRID).cast("int").alias("bin")) for name, v in values.items()])).alias("_r"))
    grids: dict[tuple[str, str], list[np.ndarray]] = {}
    for s, rule, k, good, n in binned.groupBy("_stratum", "_r.rule", "_r.bin", "_good").count().collect():
        grids.setdefault((s, rule), [np.zeros(GRID + 1, np.int64), np.zeros(GRID + 1, np.int64)])[1 - good][k] += n
    strata = max(1, len({s for s, _ in grids}))
    out = {}
    for at, (good, bad) in sorted(grids.items()):
        cut = choose_cutoff(good, bad, alpha / len(RULES), delta / (len(RULES) * strata))
        if cut is not None:
            out[at] = cut
    return out


def verdict(cutoffs: dict[tuple[str, str], int], m: str, stratum: Column) -> Column:
    """Whether a document passes the base rule and the cutoffs of its stratum."""
    values, ok = rule_values(m), ~base_failed(m)
    for (s, rule), cut in sorted(cutoffs.items()):
        ok = ok & ~((F.coalesce(stratum.cast("string"), F.lit("und")) == s) & (F.floor(values[rule] * GRID) >= cut))
    return ok


@tidy
def kept_documents(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang", key: str = "doc_id") -> DataFrame:
    """Documents that pass, with the columns they came with. Texts are measured twice, so
    that only the narrow measures are written and joined to labels."""
    cutoffs = fit(staged(measures(docs, text, stratum, key), "measures"), labels, key)
    m = fresh(docs, "measures")
    return docs.withColumn(m, measured(F.col(text))).filter(verdict(cutoffs, m, F.col(stratum))).drop(m)
