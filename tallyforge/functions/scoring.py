"""Scoring functions: marks, expected points, name and candidate scores, assignment."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Printed callback marks, what they mean and what they count. Numbers count however they are written.
MARK_WORDS = {"y": "yes", "yes": "yes", "a1": "alt1", "alt1": "alt1", "a2": "alt2", "alt2": "alt2", "a3": "alt3", "alt3": "alt3", "n": "no", "no": "no"}
MARK_NUMBERS = {10.0: "yes", 1.0: "yes", 4.5: "alt1", 2.1: "alt1", 4.3: "alt2", 2.2: "alt2", 4.2: "alt3", 2.3: "alt3", 0.0: "no", 3.0: "no"}
MARK_VALUES = {"yes": 10.0, "alt1": 4.5, "alt2": 4.3, "alt3": 4.2, "no": 0.0}
# Points of the first five places by field size, least and greatest.
TIERS = [
    (5, 10, (3, 2, 1, 0, 0)),
    (11, 19, (6, 4, 3, 2, 1)),
    (20, 39, (10, 8, 6, 4, 2)),
    (40, 79, (15, 12, 10, 8, 6)),
    (80, 129, (20, 16, 14, 12, 10)),
    (130, 1_000_000_000, (25, 22, 18, 15, 12)),
]
# Order of divisions and levels.
LEVELS = {"newcomer": 1, "novice": 2, "intermediate": 3, "advanced": 4, "allstar": 5, "champion": 6}
# Weights of a candidate's signals.
WEIGHTS = {"name": 0.65, "role": 0.10, "recency": 0.05, "division": 0.20}


def _lookup(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def _meant(raw: Column) -> Column:
    """What a mark means, null where it is unknown."""
    word = F.lower(F.trim(raw))
    return F.coalesce(F.try_element_at(_lookup(MARK_WORDS), word), F.try_element_at(_lookup(MARK_NUMBERS), word.try_cast("double")))


def mark_kind(raw: Column) -> Column:
    """yes, alt1-3 or no; unknown marks count as no."""
    return F.coalesce(_meant(raw), F.lit("no"))


def mark_value(raw: Column) -> Column:
    return F.element_at(_lookup(MARK_VALUES), mark_kind(raw))


def known_mark(raw: Column) -> Column:
    return _meant(raw).isNotNull()


def expected_points(competitors: Column, place: Column) -> Column:
    """Points for a place in a field: the tier's first five, then the extras of larger fields, else 0."""
    points = F.lit(0)
    for low, high, top in reversed(TIERS):
        tail = F.when((competitors >= 80) & (place <= 15), 2).when((competitors >= 20) & (place <= F.when(competitors >= 40, 12).otherwise(10)), 1).otherwise(0)
        in_tier = F.when(place.between(1, 5), F.element_at(F.array(*[F.lit(p) for p in top]), F.greatest(F.lit(1), F.least(F.lit(5), place.cast("int"))))).otherwise(tail)
        points = F.when(competitors.between(low, high), in_tier).otherwise(points)
    return points.cast("int")


def division_ok(division: Column, required: Column, allowed: Column) -> Column:
    """Whether a division lies between two levels; null where any is unknown."""
    level = lambda c: F.try_element_at(_lookup(LEVELS), F.lower(c))
    return level(division).between(level(required), level(allowed))


def candidate_score(name: Column, role_same: Column, recent: Column, division: Column) -> Column:
    """Weighted mean of the signals that are known; an impossible division leaves a tenth."""
    w = {k: F.lit(v) for k, v in WEIGHTS.items()}
    wd = F.when(division.isNull(), 0.0).otherwise(w["division"])
    total = w["name"] + w["role"] + w["recency"] + wd
    raw = (w["name"] * name + w["role"] * role_same.cast("double") + w["recency"] * recent.cast("double") + wd * F.coalesce(division.cast("double"), F.lit(0.0))) / total
    return F.least(F.lit(1.0), raw) * F.when(division.eqNullSafe(F.lit(False)), 0.1).otherwise(1.0)


def jaro_winkler(a: str, b: str) -> float:
    """Jaro-Winkler similarity; the common prefix counts from a similarity of 0.7 on."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, hits = [False] * len(b), []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                hits.append(ch)
                break
    if not hits:
        return 0.0
    other = [c for c, u in zip(b, used) if u]
    m, t = len(hits), sum(x != y for x, y in zip(hits, other)) // 2
    jaro = (m / len(a) + m / len(b) + (m - t) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


@F.pandas_udf(DoubleType())
def name_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler similarity of two columns, null where either is."""
    return pd.Series([None if x is None or y is None else jaro_winkler(x, y) for x, y in zip(a, b)], dtype="float64")


def _assign_group(id_a: str, id_b: str, score: str, keys: list[str], threshold: float):
    import numpy as np

    from tallyforge.operators.drift import assign

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, cols = sorted(pdf[id_a].unique()), sorted(pdf[id_b].unique())
        at_r, at_c = {r: i for i, r in enumerate(rows)}, {c: j for j, c in enumerate(cols)}
        cost = np.full((len(rows), len(cols)), 50.0)
        s = np.zeros_like(cost)
        for r, c, x in zip(pdf[id_a], pdf[id_b], pdf[score]):
            s[at_r[r], at_c[c]] = max(s[at_r[r], at_c[c]], x)
        has = s > 0
        cost[has] = -np.log(s[has])
        pairs = [(i, j) for i, j in assign(cost) if s[i, j] >= threshold]
        out = pd.DataFrame([(rows[i], cols[j], s[i, j]) for i, j in pairs], columns=[id_a, id_b, score])
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    return run


def best_assignment(candidates: DataFrame, keys: list[str], id_a: str, id_b: str, score: str, threshold: float = 0.5) -> DataFrame:
    """The one-to-one pairs of greatest total log score within each group, of at least the threshold.

    A group is one contest's role, whose size the domain bounds; the matching itself cannot be split further.
    """
    cols = [*keys, id_a, id_b, score]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in candidates.select(*cols).schema)
    return candidates.select(*cols).groupBy(*keys).applyInPandas(_assign_group(id_a, id_b, score, keys, threshold), schema)


def wilson(hits: Column, n: Column) -> tuple[Column, Column]:
    """The 95 % interval of a share."""
    z = 1.959963984540054
    p, d = hits / n, 1 + z * z / n
    mid = (p + z * z / (2 * n)) / d
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / d
    return mid - half, mid + half
