"""Generic relational operators: latest rows, precedence merges, diffs, reference checks, lookups and closures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.session import cut


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the one with the greatest order, which must be total for a fixed result.

    A rank limited to one is filtered before the shuffle as well as after it, and columns nobody asks for are never read.
    """
    return top_k(df, keys, [c.desc_nulls_last() for c in order], 1, "_rank").drop("_rank")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The k first rows per key with their rank. Catalyst keeps only k rows a key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def current(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """All rows that share the greatest order of their key, ties kept."""
    best = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_best"))
    on = [df[k].eqNullSafe(best[k]) for k in keys] + [F.struct(*order).eqNullSafe(best["_best"])]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return df.join(best, cond, "left_semi")


def precedence_merge(df: DataFrame, keys: Sequence[str], attributes: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, each attribute taken on its own from the greatest-order row where it is known."""
    by = F.struct(*order)
    return df.groupBy(*keys).agg(*[F.max_by(F.col(a), F.when(F.col(a).isNotNull(), by)).alias(a) for a in attributes])


def precedence_conflicts(df: DataFrame, keys: Sequence[str], attribute: str, order: Sequence[Column]) -> DataFrame:
    """Known values that the precedence merge passed over: keys, kept, passed_over."""
    kept = precedence_merge(df, keys, [attribute], order).withColumnRenamed(attribute, "kept")
    return df.join(kept, list(keys)).filter(F.col(attribute).isNotNull() & (F.col(attribute) != F.col("kept"))).select(*keys, F.col("kept").cast("string").alias("kept"), F.col(attribute).cast("string").alias("passed_over")).distinct()


def diff_rows(new: DataFrame, old: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Field-level changes by a null-safe full outer join: record_key, change_type, field_name, old_value, new_value.

    record_key is the keys' text joined by `|`. Null keys meet each other. Keys must be unique on either side.
    """
    pack = lambda df, name: df.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], F.struct(*[F.col(f).cast("string").alias(f) for f in fields]).alias(name))
    n, o = pack(new, "n"), pack(old, "o")
    cond = F.lit(True)
    for k in keys:
        cond = cond & n[f"n_{k}"].eqNullSafe(o[f"o_{k}"])
    both = n.join(o, cond, "full_outer").filter(~F.col("n").eqNullSafe(F.col("o")))
    key = F.concat_ws("|", *[F.coalesce(F.col(f"n_{k}").cast("string"), F.col(f"o_{k}").cast("string")) for k in keys])
    none = F.lit(None).cast("string")
    cell = lambda kind, f, a, b: F.struct(F.lit(kind).alias("change_type"), F.lit(f).alias("field_name"), a.alias("old_value"), b.alias("new_value"))
    cells = F.when(F.col("o").isNull(), F.array(cell("added", "", none, none))).when(F.col("n").isNull(), F.array(cell("removed", "", none, none))).otherwise(
        F.filter(F.array(*[cell("changed", f, F.col(f"o.{f}"), F.col(f"n.{f}")) for f in fields]), lambda c: ~c["old_value"].eqNullSafe(c["new_value"]))
    )
    return both.select(key.alias("record_key"), F.explode(cells).alias("c")).select("record_key", "c.*")


def missing_parents(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose reference is known and names no parent; null references are none."""
    return child.filter(F.col(column).isNotNull()).join(parent.select(F.col(parent_key).alias("_p")).distinct(), F.col(column) == F.col("_p"), "left_anti")


def dangling_counts(references: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(reference, n_missing) of each (name, child, column, parent, key)."""
    out = None
    for name, child, column, parent, key in references:
        one = missing_parents(child, column, parent, key).agg(F.count("*").alias("n_missing")).select(F.lit(name).alias("reference"), "n_missing")
        out = one if out is None else out.unionByName(one)
    return out


def overlap_join(left: DataFrame, right: DataFrame, on: Sequence[str], bounds: tuple[str, str, str, str], slack: int = 0) -> DataFrame:
    """Pairs that agree on `on` and whose closed intervals overlap within `slack` days; a null bound is the other bound."""
    a0, a1, b0, b1 = bounds
    start, end = lambda x, y: F.coalesce(F.col(x), F.col(y)), lambda x, y: F.coalesce(F.col(y), F.col(x))
    return left.join(right, list(on)).filter((start(a0, a1) <= F.date_add(end(b0, b1), slack)) & (start(b0, b1) <= F.date_add(end(a0, a1), slack)))


def range_lookup(rows: DataFrame, rules: DataFrame, key: str, at: str, bounds: tuple[str, str], value: str, row_id: str) -> DataFrame:
    """Each row with the rule of its key whose range holds `at`; the latest-starting bounded rule beats an open one."""
    lo, hi = bounds
    hit = rows.join(rules, key, "left").filter(F.col(lo).isNull() | (F.col(at) >= F.col(lo))).filter(F.col(hi).isNull() | (F.col(at) <= F.col(hi)))
    best = hit.groupBy(row_id).agg(F.max(F.struct(F.col(lo).isNotNull().cast("int").alias("bounded"), F.col(lo).alias("lo"), F.col(value).alias("v"))).alias("_m")).select(row_id, F.col("_m.v").alias(value))
    return rows.join(best, row_id, "left")


def unique_match(rows: DataFrame, candidates: DataFrame, on: Sequence[str], row_id: str, value: str) -> DataFrame:
    """(row_id, value, n_candidates): the candidate of each row where exactly one agrees on `on`, else null."""
    n = candidates.select(*on, value).distinct().groupBy(*on).agg(F.count("*").alias("n"), F.min(value).alias("v"))
    return rows.join(n, list(on), "left").select(row_id, F.when(F.col("n") == 1, F.col("v")).alias(value), F.coalesce("n", F.lit(0)).alias("n_candidates"))


def multiset_gap(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that `before` holds more often than `after`, with how many more; nulls equal nulls."""
    tag = lambda df, v: df.select(*columns, F.lit(v).alias("_d"))
    return tag(before, 1).unionByName(tag(after, -1)).groupBy(*columns).agg(F.sum("_d").alias("n_missing")).filter("n_missing > 0")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by several rows, with the number of rows too many."""
    return df.groupBy(*keys).agg((F.count("*") - 1).alias("n_extra")).filter("n_extra > 0")


def row_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the columns' text in order; null and '' differ."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in columns]), 256)


def replace_scope(stored: DataFrame, proposed: DataFrame, scope: Sequence[str], keys: Sequence[str], first_seen: str) -> DataFrame:
    """stored with the scopes that `proposed` brings replaced by it; a key seen before keeps its first-seen time."""
    touched = proposed.select(*scope).distinct()
    rest = stored.join(touched, list(scope), "left_anti")
    before = stored.groupBy(*keys).agg(F.min(first_seen).alias("_first"))
    kept = proposed.join(before, list(keys), "left").withColumn(first_seen, F.coalesce(F.least(F.col("_first"), F.col(first_seen)), F.col(first_seen))).drop("_first")
    return rest.unionByName(kept.select(*rest.columns)).select(*stored.columns)


def upsert(stored: DataFrame, changes: DataFrame, keys: Sequence[str], owner: Sequence[str]) -> DataFrame:
    """stored with rows of `changes` put in or over it; owner columns of a known key stay."""
    s = stored.select(F.struct(*stored.columns).alias("s"), *[F.col(k).alias(f"_{k}") for k in keys])
    c = changes.select(F.struct(*stored.columns).alias("c"), *[F.col(k).alias(f"_{k}") for k in keys])
    both = s.join(c, [f"_{k}" for k in keys], "full_outer")
    pick = [F.when(F.col("c").isNull() | (F.lit(x in owner) & F.col("s").isNotNull()), F.col(f"s.{x}")).otherwise(F.col(f"c.{x}")).alias(x) for x in stored.columns]
    return both.select(*pick)


def reach(seeds: DataFrame, edges: DataFrame, node: str, src: str, dst: str, max_rounds: int = 100) -> DataFrame:
    """Nodes reached from the seeds along edges, with the number of steps. Only the count of new nodes reaches the driver."""
    found = cut(seeds.select(node).distinct().withColumn("depth", F.lit(0)), "reach")
    front = found
    links = edges.select(src, dst).filter(F.col(src).isNotNull() & F.col(dst).isNotNull()).distinct()
    for depth in range(1, max_rounds + 1):
        step = front.join(links, F.col(node) == F.col(src)).select(F.col(dst).alias(node)).distinct()
        front = cut(step.join(found, node, "left_anti").withColumn("depth", F.lit(depth)), "reach")
        if front.isEmpty():
            return found
        found = found.unionByName(front)
    raise RuntimeError(f"not closed after {max_rounds} rounds")


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): the least node of each connected component.

    Labels hop to the least label among a node and its neighbours, then to that label's own label, so that chains halve
    each round. State is written between rounds; the driver sees one count a round.
    """
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")
    links = cut(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    label = cut(links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("c")), "labels")
    for _ in range(max_rounds):
        near = links.join(label.select(F.col("u").alias("v"), "c"), "v").groupBy("u").agg(F.min("c").alias("m"))
        low = label.join(near, "u").select("u", F.least("c", "m").alias("c"), F.col("c").alias("old"))
        hop = label.select(F.col("u").alias("c"), F.col("c").alias("cc"))
        now = cut(low.join(hop, "c", "left").select("u", F.least("c", F.coalesce("cc", "c")).alias("c"), "old"), "labels")
        label = now.select("u", "c")
        if now.filter("c <> old").isEmpty():
            return label.select(F.col("u").alias("node"), F.col("c").alias("component"))
    raise RuntimeError(f"components not closed after {max_rounds} rounds")


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Each row with `streak`: how many rows before it in a row hold the same value."""
    w = Window.partitionBy(*keys).orderBy(*order)
    change = (~F.lag(value).over(w).eqNullSafe(F.col(value))).cast("int")
    run = df.withColumn("_new", F.when(F.row_number().over(w) == 1, 1).otherwise(change)).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.withColumn("streak", F.row_number().over(Window.partitionBy(*keys, "_run").orderBy(*order)) - 1).drop("_new", "_run")


def sample_by_hash(df: DataFrame, strata: Sequence[str], row_id: str, seed: str, k: int) -> DataFrame:
    """k rows per stratum in the order of a seeded hash: the same rows on every run and every cluster."""
    order = F.sha2(F.concat_ws("|", F.lit(seed), *[F.col(s).cast("string") for s in strata], F.col(row_id).cast("string")), 256)
    return top_k(df, strata, [order.asc(), F.col(row_id).asc()], k, "sample_rank")
