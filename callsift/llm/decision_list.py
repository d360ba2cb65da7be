"""Learned decision lists: ordered threshold rules that reject documents.

Sequential covering: a rule is grown as a conjunction of thresholds by information
gain on one part of the labelled rows, pruned from its end on another part, and
kept while it is precise there; rows that it covers are set aside and the next rule
is grown. The list becomes one ordered ``when`` expression.

Learning needs labelled statistics only and works on a bounded sample of them,
``MAX_ROWS`` rows with the smallest hash of their id; the rules apply to all rows.
Null statistics count as 0; without labelled rows of both kinds the list is empty
and rejects nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that learning uses at most.
MAX_ROWS = 50_000
MAX_RULES = 16
MAX_TERMS = 4
PRECISION = 0.9
_QUANTILES = 64


@dataclass(frozen=True)
class Term:
    name: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.name] >= self.threshold if self.above else values[self.name] < self.threshold

    def column(self) -> Column:
        value = F.coalesce(F.col(self.name).cast("double"), F.lit(0.0))
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Term, ...]


def covers(rule: Rule, values: dict[str, np.ndarray]) -> np.ndarray:
    """Rows on which all terms of a rule hold."""
    return reduce(np.logical_and, (t.holds(values) for t in rule))


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Adds the term of the largest gain while rows that should stay are covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < MAX_TERMS and (inside & ~bad).any() and (inside & bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        base = np.log2(p0 / (p0 + n0))
        best: tuple[float, Term] | None = None
        for name, column in values.items():
            here, good = column[inside], bad[inside]
            cuts = np.unique(np.quantile(here, np.linspace(0, 1, _QUANTILES + 1)))
            order = np.argsort(here, kind="stable")
            below = np.searchsorted(here[order], cuts)
            hits = np.append(0, np.cumsum(good[order]))[below]
            for above in (True, False):
                p = p0 - hits if above else hits
                n = (n0 - (below - hits)) if above else below - hits
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - base), 0.0)
                k = int(np.argmax(gain))
                if gain[k] > 1e-9 and (best is None or gain[k] > best[0]):
                    best = (float(gain[k]), Term(name, above, float(cuts[k])))
        if best is None:
            break
        rule = (*rule, best[1])
        inside &= best[1].holds(values)
    return rule


def _worth(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> float:
    inside = covers(rule, values)
    p, n = (inside & bad).sum(), (inside & ~bad).sum()
    return (p - n) / (p + n) if p + n else -1.0


def learn_rules(values: dict[str, np.ndarray], bad: np.ndarray, seed: int = 7) -> list[Rule]:
    """The ordered rules that tell bad rows from the others."""
    rules: list[Rule] = []
    part = np.random.default_rng(seed).random(len(bad))
    left = np.ones(len(bad), bool)
    least = max(3, int(0.002 * len(bad)))
    while len(rules) < MAX_RULES and (bad & left).sum() >= least:
        grow, prune = left & (part < 2 / 3), left & (part >= 2 / 3)
        rule = _grow({k: v[grow] for k, v in values.items()}, bad[grow])
        if not rule:
            break
        held = {k: v[prune] for k, v in values.items()}
        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=lambda r: _worth(r, held, bad[prune]))
        inside = covers(rule, values) & left
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        if p < least or p < PRECISION * (p + n):
            break
        rules.append(rule)
        left &= ~inside
    return rules


def learn(df: DataFrame, names: list[str], label: str, key: str, max_rows: int = MAX_ROWS) -> list[Rule]:
    """Rules for rows whose label is 0, from a bounded sample of labelled rows."""
    rows = df.where(F.col(label).isin(0, 1)).select(
        F.xxhash64(key, *names).alias("_place"),
        F.col(label).cast("int").alias("_label"),
        *[F.coalesce(F.col(x).cast("double"), F.lit(0.0)).alias(x) for x in names],
    )
    sample = rows.orderBy("_place").limit(max_rows).collect()
    values = {x: np.array([row[x] for row in sample], float) for x in names}
    return learn_rules(values, np.array([row["_label"] == 0 for row in sample], bool))


def verdict(rules: list[Rule]) -> Column:
    """Whether a row stays: the first rule that holds rejects it."""
    if not rules:
        return F.lit(True)
    first, *rest = rules
    expression = F.when(reduce(Column.__and__, (t.column() for t in first)), False)
    for rule in rest:
        expression = expression.when(reduce(Column.__and__, (t.column() for t in rule)), False)
    return expression.otherwise(True)


def fired(rules: list[Rule]) -> Column:
    """The text of the rule that rejects a row, else null."""
    expression = F.lit(None).cast("string")
    for rule in reversed(rules):
        held = reduce(Column.__and__, (t.column() for t in rule))
        expression = F.when(held, " and ".join(map(str, rule))).otherwise(expression)
    return expression
