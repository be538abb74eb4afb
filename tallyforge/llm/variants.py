"""Variant spellings of names, by merging and matching again.

Every distinct name is read into a form. Forms are the first profiles; a profile is the union of the given names and of the
surname spellings merged into it. A round judges all pairs between the profiles as they have grown: a short form that
fitted two profiles fits one after these merge, and a rare spelling is measured against the whole weight of a profile. When
nothing merges any more, the unions that have grown are looked up again among all names, since a spelling may fit what two
forms hold together and neither alone; new pairs start new rounds. Without a merge no union grows and no pair is new.
"""

from __future__ import annotations

from collections import defaultdict
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.names import FORM, learned_nicknames, meet, nickname_owners, single_names, source_keys, target_keys, word_slips
from tallyforge.session import cut

MAX_ROUNDS = 60  # more rounds than merges can take is an error, not a cut
RARE = 0.2  # a slip's word has at most two partners, or this share of the right word's
CLEAR = 6.0  # a short form goes to a profile that outweighs all others it fits so many times
FORM_COLUMNS = ["form", *FORM]
RARE_SHORT = 0.5  # the same for a short form without a dot


def profiles(names: DataFrame, nicknames: DataFrame) -> DataFrame:
    """(form, n, root): each form of the names' persons, and the profile it ended in."""
    forms = names.groupBy(F.concat_ws("|", "x", "y").alias("form")).agg(F.sum("n").alias("n"), *[F.max(c).alias(c) for c in ("x", "y", "hx", "hy")])
    forms = cut(forms, "forms")
    words = forms.filter("x <> '' and y <> '' and not x like '%*' and not y like '%*'").select(F.explode(F.array("x", "y")).alias("word"))
    partners = words.groupBy("word").agg(F.count("*").alias("d"))
    slips = (
        word_slips(forms, forms).join(partners.select(F.col("word").alias("a"), F.col("d").alias("da")), "a", "left").join(partners.select(F.col("word").alias("b"), F.col("d").alias("db")), "b")
        .filter(F.coalesce("da", F.lit(0)) <= F.greatest(F.lit(2.0), RARE * F.col("db"))).select("a", "b")
    )
    slips, partners = cut(slips, "slips"), cut(partners, "partners")
    # The keys of all names are written once; a round looks up only what has grown.
    owners = nickname_owners(nicknames)
    sources, targets = cut(source_keys(forms, slips, owners), "sources"), cut(target_keys(forms, owners), "targets")
    pairs = cut(_fit(meet(sources, targets.hint("merge")), partners), "pairs")
    state = forms.select(*FORM_COLUMNS, "n", F.col("form").alias("root"), F.col("n").alias("w"), F.lit(False).alias("grew"))
    for _ in range(MAX_ROUNDS):
        merges = cut(_merges(state, _closest(pairs)), "merges")
        if not merges.isEmpty():
            moved = state.drop("w").join(merges, "root", "left")
            moved = moved.select(*FORM_COLUMNS, "n", F.coalesce("into", "root").alias("root"), (F.col("grew") | F.col("into").isNotNull()).alias("grew"))
            state = _weighed(cut(moved.distinct(), "moved"))
            continue
        # Nothing merges as things stand: what has grown since the last look enters the blocking again.
        grown = cut(_unions(state.join(state.filter("grew").select("root").distinct(), "root", "left_semi")), "unions")
        size = grown.count()
        if not size:
            return state.filter("n > 0").select("form", "n", "root", "w")
        new = grown.select(*FORM_COLUMNS).distinct()
        new_sources, new_targets = cut(source_keys(new, slips, owners), "sources"), cut(target_keys(new, owners), "targets")
        few = lambda df: F.broadcast(df) if size <= FEW else df.hint("merge")
        sources, met = sources.unionByName(new_sources), meet(few(new_sources), targets)
        targets, met = targets.unionByName(new_targets), met.unionByName(meet(sources, few(new_targets)))
        every = state.drop("w", "grew").unionByName(grown)
        same = few(grown.select("form", "root")).join(every.select("form", F.col("root").alias("r")), "form").filter("r <> root").select("form", F.col("form").alias("target"), F.lit("half").alias("kind"), F.lit(False).alias("rarer"))
        found = cut(_fit(met, partners).unionByName(same), "found")
        pairs = cut(pairs.unionByName(found).distinct(), "pairs")
        state = _weighed(every.withColumn("grew", F.lit(False)))
    raise RuntimeError(f"merging went on after {MAX_ROUNDS} rounds")


def _weighed(forms: DataFrame) -> DataFrame:
    """The forms with the weight of their profiles."""
    return cut(forms.join(forms.groupBy("root").agg(F.sum("n").alias("w")), "root"), "state")


FEW = 10_000  # grown names of a round whose keys, some twenty each, are broadcast


def _fit(met: DataFrame, partners: DataFrame) -> DataFrame:
    """(form, target, kind, rarer): the pairs of forms whose words are rare enough for what parts them."""
    return (
        met
        .join(partners.select(F.col("word").alias("a"), F.col("d").alias("da")), "a", "left")
        .join(partners.select(F.col("word").alias("b"), F.col("d").alias("db")), "b", "left")
        .filter((F.col("kind") != "short") | F.col("a").endswith("*") | (F.col("da") <= F.greatest(F.lit(1.0), RARE_SHORT * F.col("db"))))
        .select("form", "target", F.when(F.col("two"), "two").otherwise(F.col("kind")).alias("kind"), (~F.col("two") & (F.col("kind") == "slip") & (F.col("da") < F.col("db")) & (F.col("da") <= RARE * F.col("db"))).alias("rarer"))
    )


def _closest(pairs: DataFrame) -> DataFrame:
    """pairs without those in two parts of forms that depart in one part from some name."""
    near = pairs.filter("kind <> 'two'")
    return near.unionByName(pairs.filter("kind = 'two'").join(near.select("form").distinct(), "form", "left_anti"))


def union_forms(forms: list[tuple]) -> list[tuple[str, str]]:
    """The names that a profile's forms (x, y, weight) hold together and none of them alone, as pairs of words in alphabetical order.

    Forms that share a word have it on the same side, so the sides of a profile's words follow from its heaviest form. A
    form that shares none goes the way it looks more alike. An abbreviation adds its surname, but no given name, since it stands for one
    that the profile holds.
    """
    weight: dict[tuple[str, str], int] = defaultdict(int)
    for x, y, n in forms:
        if x and y and x != y:
            weight[x, y] += n
    left = sorted(weight, key=lambda f: (f[0].endswith("*") or f[1].endswith("*"), -weight[f], f))
    if not left or any(p.endswith("*") for p in left[0]):
        return []
    printed, side = set(left), {left[0][0]: 0, left[0][1]: 1}
    words = lambda k: [w for w, at in side.items() if at == k]
    alike = lambda p, k: max((1.0 if p.endswith("*") and w.startswith(p[:-1]) else SequenceMatcher(None, p, w).ratio()) for w in words(k))
    left = left[1:]
    while left:
        f = next((f for f in left if f[0] in side or f[1] in side), left[0])
        left.remove(f)
        x, y = f
        if x in side or y in side:
            at = side[x] if x in side else 1 - side[y]
        else:
            at = 0 if alike(x, 0) + alike(y, 1) >= alike(x, 1) + alike(y, 0) else 1
        for p, k in ((x, at), (y, 1 - at)):
            if not p.endswith("*"):
                side.setdefault(p, k)
    return sorted({(min(a, b), max(a, b)) for a in words(0) for b in words(1)} - printed)


def _union_batches(batches):
    for batch in batches:
        out = defaultdict(list)
        for root, forms in zip(batch.column("root").to_pylist(), batch.column("forms").to_pylist()):
            hyphens = {w: h for f in forms for w, h in ((f["x"], f["hx"]), (f["y"], f["hy"])) if h}
            for x, y in union_forms([(f["x"], f["y"], f["n"]) for f in forms]):
                for c, v in (("form", f"{x}|{y}"), ("x", x), ("y", y), ("hx", hyphens.get(x)), ("hy", hyphens.get(y)), ("n", 0), ("root", root)):
                    out[c].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out[c], pa.int64() if c == "n" else pa.string()) for c in [*FORM_COLUMNS, "n", "root"]], [*FORM_COLUMNS, "n", "root"])


def _unions(state: DataFrame) -> DataFrame:
    """The names that profiles hold together and none of their forms alone, with n = 0. A profile's forms are one person's spellings."""
    grouped = state.groupBy("root").agg(F.collect_list(F.struct("x", "y", "hx", "hy", "n")).alias("forms")).filter(F.size("forms") > 1)
    return grouped.mapInArrow(_union_batches, "form string, x string, y string, hx string, hy string, n long, root string")


def _merges(state: DataFrame, pairs: DataFrame) -> DataFrame:
    """(root, into): which profiles merge in this round, every one into a heavier one.

    A slip goes to the heaviest profile it may come from, which outweighs it or whose word is far more common. Short forms,
    halves and names that depart in two parts merge only where one profile fits, or outweighs the others that fit CLEAR
    times; the last two only into a profile of at least their weight. A chain of merges closes
    in the rounds after, since each takes at least one profile away.
    """
    a = state.select("form", F.col("root").alias("a"), F.col("w").alias("wa"))
    b = state.select(F.col("form").alias("target"), F.col("root").alias("b"), F.col("w").alias("wb"))
    into = F.struct("wb", "b")
    heavier = into > F.struct(F.col("wa").alias("wb"), F.col("a").alias("b"))
    slip = (F.col("kind") == "slip") & (F.col("rarer") | heavier)
    fit = F.col("kind") != "slip"
    met = (
        pairs.join(a, "form").join(b, "target").filter(F.col("a") != F.col("b"))
        .groupBy("a", "wa", "b", "wb").agg(F.max(slip).alias("slip"), F.max(fit).alias("fit"), F.min(F.when(fit, F.col("kind").isin("half", "two"))).alias("half"))
    )
    each = met.groupBy("a", "wa").agg(
        F.max(F.when(F.col("slip"), into)).alias("slip"), F.max(F.when(F.col("fit"), into)).alias("most"),
        F.sum(F.when(F.col("fit"), F.col("wb"))).alias("all"), F.max_by("half", F.when(F.col("fit"), into)).alias("half"),
    )
    clear = F.col("most.wb") >= CLEAR * (F.col("all") - F.col("most.wb"))
    sole = F.when(clear & (~F.col("half") | (F.col("wa") <= F.col("most.wb"))), F.col("most"))
    chosen = each.withColumn("h", F.coalesce("slip", sole)).filter("h is not null").withColumn("me", F.struct(F.col("wa").alias("wb"), F.col("a").alias("b")))
    ordered = chosen.select(F.least("me", "h").alias("lo"), F.greatest("me", "h").alias("hi"))
    return ordered.groupBy(F.col("lo.b").alias("root")).agg(F.max("hi").alias("h")).select("root", F.col("h.b").alias("into"))


def spelling_groups(names: DataFrame, nicknames: DataFrame) -> DataFrame:
    """(name_raw, n, root): each distinct name of one person with its profile.

    `names` has a column name_raw; null and blank names and names of several persons are left out, repeats only add
    weight. Names of one word link by that word alone. An abbreviation that fits several profiles, none CLEAR times
    the weight of the others, stays by itself with the other spellings of the same abbreviation. Names without any letter are left out.
    """
    read = cut(single_names(names), "names")
    known = cut(nicknames.select("nickname", "canonical").unionByName(learned_nicknames(read)), "nicknames")
    found = profiles(read, known)
    return read.withColumn("form", F.concat_ws("|", "x", "y")).join(found.select("form", "root"), "form").select("name_raw", "n", "root")


def spelling_pairs(groups: DataFrame) -> DataFrame:
    """(name_a, name_b): each pair of different spellings of one profile, name_a first by code points."""
    a = groups.select("root", F.col("name_raw").alias("name_a"))
    b = groups.select("root", F.col("name_raw").alias("name_b"))
    return a.join(b, "root").filter(F.col("name_a") < F.col("name_b")).select("name_a", "name_b")
