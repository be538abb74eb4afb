"""Matching entities across sources without keys, by soft logic.

A candidate link between a record and an entity has a truth value between 0 and 1. Weighted rules bind the values:

* similar names are linked, as far as the similarity goes; links are false without evidence;
* exclusivity: a record has one entity, and an entity one record in a group (a contest's role);
* transitivity: a record of a spelling that means an entity is linked to it, and a link says what its spelling means. What
  a spelling means is a value of its own, so that the rule needs no pairs of records.

The distances to the rules' satisfaction are hinge losses, so the most probable values are the minimum of a convex problem.
It is solved by the alternating direction method of multipliers: every rule keeps a copy of the values it binds and moves
it to its own optimum in closed form; the copies are averaged, and multipliers carry what they still disagree on. A step is
sums by record, by group and by spelling, so it runs on all executors; values are the links' confidence.

Evidence reaches from equal names down to a surname shared in one event, division and role, so that many records have
several candidates and many entities several claims, and the rules decide among them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.clean import folded
from tallyforge.llm.names import FORM, form_of, form_pairs, read_name, single_names, word_slips
from tallyforge.session import cut

W_SIMILAR, W_PRIOR, W_EXCLUSIVE, W_SAME = 2.5, 0.25, 3.0, 0.3
RHO, RELAX = 2.0, 1.7  # step of the multipliers, and how far a step goes beyond the copies
STEPS = 6  # steps between two written tables
TOLERANCE, MAX_STEPS = 0.01, 120  # steps end where copies and values move less than this, or after so many
ACCEPT = 0.5  # least confidence of a match
# Similarity by the kind of agreement of two names.
SIMILARITY = {"exact": 1.0, "glued": 0.9, "slip": 0.85, "nick": 0.85, "half": 0.8, "short": 0.75, "long": 0.75}
SIMILARITY_TWO = 0.85  # factor for a slip in the other part as well
PRINTED_ID = 0.1  # what a printed id that agrees adds
SURNAME, PRINTED_SURNAME = 0.3, 0.7  # similarity of names that share the surname only, and where the printed id agrees, too
LEARNED, MIN_FAMILIES = 0.75, 2  # similarity where the two given names belong to each other in as many surnames, and how many


def weight(s):
    """The weight of the similarity rule: the weaker the evidence, the sooner it yields to other rules."""
    return W_SIMILAR * s * s


def free_value(s):
    """The minimum of similarity and prior alone."""
    return weight(s) * s / (weight(s) + W_PRIOR)


def solve(links: DataFrame) -> DataFrame:
    """(record, entity, confidence) from candidate links (record, entity, contest, spelling, s).

    s is the similarity in [0, 1]; one row per record and entity. Links that no rule binds to another one have their
    minimum in closed form; the others go through the alternating steps until these stand still.
    """
    links = cut(links.select("record", "entity", "contest", "spelling", "s"), "candidates")
    links = _with(_with(links, ["record"], F.count("*").alias("n_record")), ["contest", "entity"], F.count("*").alias("n_claims"))
    links = links.withColumn("rivals", (F.col("n_record") > 1) | (F.col("n_claims") > 1))
    # A spelling's links to an entity bind one another if any of them has rivals or their similarities differ.
    same = [F.count("*").alias("n_same"), (F.max("rivals") | (F.max("s") - F.min("s") > 1e-9)).alias("bound")]
    links = cut(_with(links, ["spelling", "entity"], *same), "links")
    free = free_value(F.col("s"))
    settled = links.filter("not bound").select("record", "entity", free.alias("confidence"))
    state = links.filter("bound").select("record", "entity", "contest", "spelling", "s", "n_record", "n_claims", "n_same", free.alias("x"), free.alias("z"), *[F.lit(0.0).alias(f"u{k}") for k in range(5)])
    done = 0
    while True:
        for _ in range(STEPS):
            state = _step(state)
        state, done = cut(state, "values"), done + STEPS
        moving = state.agg(F.max("residual").alias("r")).first().r
        if moving is None or moving < TOLERANCE or done >= MAX_STEPS:
            return settled.unionByName(state.select("record", "entity", F.col("x").alias("confidence")))


def _with(df: DataFrame, keys: list[str], *aggregates) -> DataFrame:
    """df with aggregates of its groups: partial sums and a join, which AQE may split, so that no group has to fit one task."""
    return df.join(df.groupBy(*keys).agg(*aggregates), keys)


def _step(state: DataFrame) -> DataFrame:
    """One round: every rule moves its copy, the copies are averaged, the multipliers follow.

    Copies 0 to 3 are the link's: similarity with prior, its record's exclusivity, its entity's, and transitivity; copy 4
    is that of what the spelling means. Sums of groups are windows, over bound links only: joins instead took more driver
    memory for their plans than the steps are worth. A window streams its group and spills it.
    """
    v = [F.col("x") - F.col(f"u{k}") for k in range(4)] + [F.col("z") - F.col("u4")]
    # Similarity and prior share one copy: min w1 max(0, s - y)^2 + w0 y^2 + rho/2 (y - v)^2.
    w = weight(F.col("s"))
    below = (2 * w * F.col("s") + RHO * v[0]) / (2 * w + 2 * W_PRIOR + RHO)
    above = RHO * v[0] / (2 * W_PRIOR + RHO)
    y0 = F.when(below < F.col("s"), below).otherwise(F.greatest(above, F.col("s")))

    def exclusive(value, n, *keys):
        """min w max(0, sum y - 1) + rho/2 |y - v|^2: all members give up the same share of the excess."""
        total = F.when(F.col(n) > 1, F.sum(value).over(Window.partitionBy(*keys))).otherwise(value)
        return value - F.least(F.greatest((total - 1) / F.col(n), F.lit(0.0)), F.lit(W_EXCLUSIVE / RHO))

    # Both ways of transitivity: min w |z - y| + rho/2 (y - v3)^2 + rho/2 (z - v4)^2 moves both sides to each other.
    apart = v[4] - v[3]
    give = F.signum(apart) * F.least(F.lit(W_SAME / RHO), F.abs(apart) / 2)
    copies = {"y0": y0, "y3": v[3] + give, "y4": v[4] - give}
    moved = state.withColumns(copies).withColumn("y1", exclusive(v[1], "n_record", "record")).withColumn("y2", exclusive(v[2], "n_claims", "contest", "entity"))
    target = lambda k: F.col("z") if k == 4 else F.col("x")
    moved = moved.withColumns({f"r{k}": RELAX * F.col(f"y{k}") + (1 - RELAX) * target(k) for k in range(5)})
    clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    means = F.sum(F.col("r4") + F.col("u4")).over(Window.partitionBy("spelling", "entity")) / F.col("n_same")
    moved = moved.withColumns({"x_new": clip(sum(F.col(f"r{k}") + F.col(f"u{k}") for k in range(4)) / 4), "z_new": clip(means)})
    new = lambda k: F.col("z_new") if k == 4 else F.col("x_new")
    residual = F.greatest(F.abs(F.col("x_new") - F.col("x")), F.abs(F.col("z_new") - F.col("z")), *[F.abs(F.col(f"y{k}") - new(k)) for k in range(5)])
    return moved.select(
        "record", "entity", "contest", "spelling", "s", "n_record", "n_claims", "n_same", F.col("x_new").alias("x"), F.col("z_new").alias("z"),
        *[(F.col(f"u{k}") + F.col(f"r{k}") - new(k)).alias(f"u{k}") for k in range(5)], residual.alias("residual"),
    )


def _people_forms(batches):
    for pdf in batches:
        rows = []
        for key, first, last in zip(pdf.entity, pdf.first_name, pdf.last_name):
            a, b, _ = read_name(f"{last or ''}, {first or ''}")
            if a and b:
                rows.append((key, *form_of(a, b), a.replace("-", ""), b.replace("-", ""), b))
        yield pd.DataFrame(rows, columns=["entity", *FORM, "given", "surname", "pieces"])


def people_forms(people: DataFrame) -> DataFrame:
    """(entity, x, y, hx, hy, given, surname, pieces) of registered people with both names. people has entity, first_name, last_name."""
    kind = people.schema["entity"].dataType.simpleString()
    known = people.filter("entity is not null").groupBy("entity").agg(F.max(F.struct("first_name", "last_name")).alias("m")).select("entity", "m.*")
    return known.mapInPandas(_people_forms, f"entity {kind}, x string, y string, hx string, hy string, given string, surname string, pieces string")


def name_targets(forms: DataFrame, people: DataFrame, nicknames: DataFrame) -> DataFrame:
    """(form, target, s): which registered names a form may be. people has x, y, hx, hy."""
    exact = forms.select(F.concat_ws("|", "x", "y").alias("target")).distinct().select(F.col("target").alias("form"), "target", F.lit("exact").alias("kind"), F.lit(False).alias("two"))
    targets = people.groupBy("x", "y").agg(F.max("hx").alias("hx"), F.max("hy").alias("hy"))
    slips = cut(word_slips(forms, targets), "slips")
    similar = form_pairs(forms, targets, nicknames, slips, both=True).select("form", "target", "kind", "two")
    score = F.create_map(*[F.lit(v) for kv in SIMILARITY.items() for v in kv])
    s = score[F.col("kind")] * F.when(F.col("two"), SIMILARITY_TWO).otherwise(1.0)
    return exact.unionByName(similar).groupBy("form", "target").agg(F.max(s).alias("s"))


def surname_links(rows: DataFrame, registered: DataFrame, strong: DataFrame) -> DataFrame:
    """(record, entity, contest, spelling, s): links of records to entities of their block that share the surname only.

    Two given names that meet in this way in several surnames, where neither the record nor the entity has a better
    partner, belong to each other (a nickname that no table lists); unrelated namesakes hardly repeat.
    """
    words = lambda word, other: F.struct(F.col(word).alias("surname"), F.col(other).alias("given"))
    full = rows.filter("x <> '' and y <> '' and not x like '%*' and not y like '%*'")
    mine = full.select("record", "printed", "contest", "block", F.concat_ws("|", "x", "y").alias("spelling"), F.explode(F.array(words("x", "y"), words("y", "x"))).alias("w")).select("*", "w.*").drop("w")
    pieces = F.array_distinct(F.concat(F.array("surname"), F.filter(F.split("pieces", "-"), lambda p: F.length(p) >= MIN_PIECE)))
    theirs = registered.select("entity", "block", F.col("given").alias("e_given"), F.explode(pieces).alias("surname"))
    met = mine.join(theirs, ["block", "surname"]).filter("given <> e_given").join(strong.select("record", "entity"), ["record", "entity"], "left_anti")
    met = cut(met.join(strong.groupBy("record").agg(F.lit(True).alias("has")), "record", "left").join(strong.groupBy("block", "entity").agg(F.lit(True).alias("claimed")), ["block", "entity"], "left"), "surnames")
    families = met.filter("has is null and claimed is null").groupBy("given", "e_given").agg(F.countDistinct("surname").alias("families"))
    learned = met.join(families, ["given", "e_given"], "left")
    s = F.when(F.col("families") >= MIN_FAMILIES, LEARNED).when(F.col("printed") == F.col("entity"), PRINTED_SURNAME).otherwise(SURNAME)
    return learned.select("record", "entity", "contest", "spelling", "block", s.alias("s"))


MIN_PIECE = 4  # letters of a half or of a surname without particles that counts as the surname


def candidate_links(entries: DataFrame, registry: DataFrame, people: DataFrame, events: DataFrame, nicknames: DataFrame) -> DataFrame:
    """(record, entity, contest, spelling, s): every link that some evidence speaks for.

    A record and an entity meet only inside a block, the event, division and role that the registry has a row of the entity
    for. There they join on the registered names that the record's spelling may be, and on the surname.
    """
    letter = F.regexp_extract("entry_id", r"/([A-Za-z])-[^/]*$", 1)
    role = F.when(letter == "L", "leader").when(letter == "F", "follower")
    division = F.lower(F.regexp_extract("contest_id", r"/([A-Za-z]+)-[^/]*$", 1))
    block = lambda event, division, role: F.concat_ws("\t", event, division, role)
    rows = entries.select(
        F.col("entry_id").alias("record"), "name_raw", F.col("wsdc_id").alias("printed"), F.concat_ws("/", "contest_id", role).alias("contest"),
        block(folded(F.col("event_id")), division, role).alias("block"), role.alias("role"), F.col("event_id").isNotNull().alias("placed"),
    ).filter(F.col("role").isNotNull() & F.col("placed") & (F.length(F.trim("name_raw")) > 0)).drop("role", "placed")
    names = cut(single_names(rows.select("name_raw")), "names")
    known = cut(people_forms(people.withColumnRenamed("wsdc_id", "entity")), "people")
    targets = name_targets(names.select(*FORM), known, nicknames)
    month = F.date_format("event_month", "yyyy-MM")
    by_month = events.filter("series_id is not null and event_month is not null").select(folded(F.col("series_id")).alias("series"), F.col("event_month").alias("month"), folded(F.col("event_id")).alias("by_month")).distinct()
    told = registry.select(folded(F.col("event_id")).alias("event"), folded(F.col("series_id")).alias("series"), month.alias("month"), folded(F.col("division")).alias("division"), folded(F.col("role")).alias("role"), F.col("wsdc_id").alias("entity"))
    direct = told.filter("event is not null").select("event", "division", "role", "entity")
    dated = told.filter("event is null").join(by_month, ["series", "month"]).select(F.col("by_month").alias("event"), "division", "role", "entity")
    whole = direct.unionByName(dated).filter("event is not null and division is not null and role is not null").select(block(F.col("event"), F.col("division"), F.col("role")).alias("block"), "entity").distinct()
    registered = cut(whole.join(known, "entity").select("block", "entity", F.concat_ws("|", "x", "y").alias("target"), "given", "surname", "pieces"), "registered")
    rows = cut(rows.join(names.select("name_raw", "x", "y"), "name_raw").drop("name_raw").distinct(), "rows")
    spelled = rows.withColumn("spelling", F.concat_ws("|", "x", "y"))
    strong = spelled.join(targets.withColumnRenamed("form", "spelling"), "spelling").join(registered.select("block", "entity", "target"), ["block", "target"])
    s = F.least(F.lit(1.0), F.col("s") + F.when(F.col("printed") == F.col("entity"), PRINTED_ID).otherwise(0.0))
    strong = cut(strong.select("record", "entity", "contest", "spelling", "block", s.alias("s")), "strong")
    every = strong.unionByName(surname_links(rows, registered, strong))
    return every.groupBy("record", "entity").agg(F.max("s").alias("s"), F.max("contest").alias("contest"), F.max("spelling").alias("spelling"))


def link_entries(entries: DataFrame, registry: DataFrame, people: DataFrame, events: DataFrame, nicknames: DataFrame) -> DataFrame:
    """(entry_id, wsdc_id, confidence): the registered dancer each entry of one person names.

    A candidate needs a registry row of the dancer for the entry's event (by event_id, else by series and month), its
    division (as its contest's id says) and its letter's role, and a name that shares something with the dancer's. Entries
    with a null, blank or packed name, of other letters, or without any candidate give no row, nor do ties that no rule
    breaks. Repeated rows of an entry count once. The printed id is a hint only. Empty tables give an empty result.
    """
    solved = solve(candidate_links(entries, registry, people, events, nicknames))
    best = solved.groupBy("record").agg(F.max(F.struct("confidence", "entity")).alias("m"), F.sum("confidence").alias("all"))
    clear = F.col("m.confidence") > F.col("all") - F.col("m.confidence") + MARGIN
    return best.filter((F.col("m.confidence") >= ACCEPT) & clear).select(F.col("record").alias("entry_id"), F.col("m.entity").alias("wsdc_id"), F.col("m.confidence").alias("confidence"))


MARGIN = 0.02  # what a match must be ahead of all others by: twice what the steps may still move
