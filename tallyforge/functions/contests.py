"""The vocabulary of contests, rounds, roles and cells as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.text import paired, slug

# Phrases of a contest's name and what they say; the first that the name holds counts.
DIVISIONS = [
    ("newcomer", "newcomer"), ("novice", "novice"), ("intermediate", "intermediate"), ("advanced", "advanced"), ("all star", "allstar"),
    ("allstar", "allstar"), ("champion", "champion"), ("invit", "invitational"), ("open", "open"),
]
AGES = [("junior", "juniors"), ("soph", "sophisticated"), ("master", "masters")]
TYPES = [
    ("strictly", "strictly"), ("classic", "classic"), ("showcase", "showcase"), ("pro am", "pro_am"), ("proam", "pro_am"), ("rising star", "rising_star"),
]
PARTNERS = {"jack_and_jill": "random_partner", "strictly": "open_couple", "other": "open_couple"}  # all other types: a couple for good
COMBINED = [("newcomer", "newcomer"), ("novice", "novice"), ("intermediate", "intermediate"), ("advanced", "advanced"), ("all star", "allstar"), ("champion", "champion")]
SHORT_TYPES = {"jack_and_jill": "jj", "strictly": "strictly", "classic": "classic", "showcase": "showcase", "pro_am": "pro-am", "rising_star": "rising-star"}
# Words of a name that what has been recognised accounts for.
ALWAYS = ["division", "wcs", "wsdc", "west", "coast"]
ROLE_WORDS = ["leader", "leaders", "follower", "followers"]
ACCOUNTED = {
    "contest_type": {
        "jack_and_jill": ["jack", "jill", "and", "n"], "strictly": ["strictly", "swing"], "classic": ["classic", "routine", "routines"],
        "showcase": ["showcase", "routine", "routines"], "pro_am": ["pro", "am", "proam", "routine", "routines"], "rising_star": ["rising", "star", "routine", "routines"],
    },
    "division": {
        "newcomer": ["newcomer"], "novice": ["novice"], "intermediate": ["intermediate"], "advanced": ["advanced"], "allstar": ["all", "star", "stars", "allstar"],
        "champion": ["champion", "champions"], "invitational": ["invitational", "invit"], "open": ["open"],
    },
    "age_division": {"juniors": ["junior", "juniors"], "sophisticated": ["sophisticated", "soph"], "masters": ["master", "masters"]},
    "dance_style": {"country": ["country", "csdc"], "lindy": ["lindy"], "wcs": ["swing"], "other": ["swing"]},
}
NO_POINTS = ["none", "open", "invitational"]


def words_of(name: Column) -> Column:
    """A name as lower-case words of letters and digits, with & read as and."""
    return F.trim(F.regexp_replace(F.replace(F.lower(name), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def _first(value: Column, phrases: list[tuple[str, str]], default: str) -> Column:
    held = [F.when(F.contains(value, F.lit(p)), F.lit(label)) for p, label in phrases]
    return F.coalesce(*held, F.lit(default))


def classify(name: Column) -> dict[str, Column]:
    """division, age_division, contest_type, partner_mode, dance_style and combined_from of a contest's name."""
    v = words_of(name)
    has = lambda w: F.contains(v, F.lit(w))
    kind = F.when(has("jack") & has("jill"), "jack_and_jill").otherwise(_first(v, TYPES, "other"))
    style = F.when(has("lindy"), "lindy").when(has("country") | F.array_contains(F.split(v, " "), "csdc"), "country").when(has("hustle"), "other").otherwise("wcs")
    parts = F.filter(F.array(*[F.when(has(p), F.lit(label)) for p, label in COMBINED]), lambda x: x.isNotNull())
    partner = F.coalesce(*[F.when(kind == k, F.lit(p)) for k, p in PARTNERS.items()], F.lit("perm_couple"))
    return {
        "division": _first(v, DIVISIONS, "none"), "age_division": _first(v, AGES, "none"), "contest_type": kind, "partner_mode": partner,
        "dance_style": style, "combined_from": F.when(F.size(parts) > 1, parts).otherwise(F.array().cast("array<string>")),
    }


def qualifier(name: Column) -> Column:
    """The words of a contest's name that nothing recognised in it accounts for, joined by hyphens; '' for types not known."""
    v, known = words_of(name), classify(name)
    strings = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    used = [strings(ALWAYS), F.when(F.contains(v, F.lit("pro am")) | F.array_contains(F.split(v, " "), "proam"), strings([])).otherwise(strings(ROLE_WORDS))]
    for field, words in ACCOUNTED.items():
        used.append(F.coalesce(*[F.when(known[field] == label, strings(ws)) for label, ws in words.items()], strings([])))
    left = F.filter(F.split(v, " "), lambda w: ~F.array_contains(F.concat(*used), w))
    return F.when(known["contest_type"] == "other", F.lit("")).otherwise(F.array_join(left, "-"))


def contest_slug(name: Column) -> Column:
    """style-age-division-type-qualifier, without what is usual or missing."""
    known = classify(name)
    kind = F.coalesce(*[F.when(known["contest_type"] == k, F.lit(s)) for k, s in SHORT_TYPES.items()], slug(name))
    parts = [F.when(known[k] != usual, known[k]) for k, usual in (("dance_style", "wcs"), ("age_division", "none"), ("division", "none"))]
    return F.array_join(F.filter(F.array(*parts, kind, qualifier(name)), lambda x: x.isNotNull() & (x != "")), "-")


def points_eligible(name: Column) -> Column:
    """Whether a contest may bring registry points by its name."""
    known = classify(name)
    return (known["dance_style"] == "wcs") & (known["contest_type"] == "jack_and_jill") & ~known["division"].isin(*NO_POINTS) & (qualifier(name) == "")


def round_type(label: Column) -> Column:
    """final, semifinal, quarterfinal or prelim; the word final alone is no longer one beside semi or quarter."""
    v = F.lower(label)
    has = lambda w: F.contains(v, F.lit(w))
    return F.when(has("semi"), "semifinal").when(has("quarter"), "quarterfinal").when(has("final"), "final").otherwise("prelim")


def round_number(label: Column) -> Column:
    """The first number that stands by itself or behind `round`, else 1."""
    return F.coalesce(F.nullif(F.regexp_extract(label, r"(?i)\b(?:round\s*)?(\d+)\b", 1), F.lit("")).cast("int"), F.lit(1))


def display_name(name: Column) -> Column:
    """A contest's name without the words of its role."""
    return F.trim(F.regexp_replace(F.regexp_replace(name, r"(?i)\b(?:leaders?|followers?)\b", " "), r"\s+", " "))


def role_of(header: Column, contest: Column, n_columns: Column, position: Column) -> Column:
    """The role a competitor column stands for: from its header, the contest's name, and where it stands among how many. Null for am and pro."""
    h, both = F.lower(F.trim(header)), F.lower(F.concat_ws(" ", F.trim(header), contest))
    has = lambda w: F.contains(both, F.lit(w))
    couples = has("strictly") | has("classic") | has("showcase")
    return (
        F.when(h == "couple", "couple").when(has("follower"), "follower").when(has("leader"), "leader").when(h.isin("am", "pro"), F.lit(None))
        .when((h == "") & (n_columns == 2), F.when(position == 0, "leader").otherwise("follower")).when((n_columns == 1) & couples, "couple").otherwise("leader")
    )


def competitors(cell: Column, header: Column, contest: Column, n_columns: Column, position: Column) -> Column:
    """The (role, name) of a cell: one person, a couple that stands as one, or the two of a line that one column holds.

    Pro-am cells take the role that the contest leaves: its amateurs dance the role it names.
    """
    h, c = F.lower(F.trim(header)), F.lower(contest)
    one = lambda role, name: F.array(F.struct(role.cast("string").alias("role"), name.alias("name")))
    none = F.array().cast("array<struct<role:string,name:string>>")
    several = F.size(paired(cell)) > 1
    halves = F.transform(F.split(cell, r"(?i)\s+and\s+", 2), lambda p: F.trim(p))
    both = F.array(F.struct(F.lit("leader").alias("role"), halves[0].alias("name")), F.struct(F.lit("follower").alias("role"), F.try_element_at(halves, F.lit(2)).alias("name")))
    splits = (h != "couple") & (n_columns == 1) & F.contains(c, F.lit("jack")) & F.contains(c, F.lit("jill")) & (F.size(halves) == 2) & (halves[0] != "") & (F.try_element_at(halves, F.lit(2)) != "")
    named = F.when(F.contains(c, F.lit("follower")), F.lit("follower")).when(F.contains(c, F.lit("leader")), F.lit("leader"))
    pro_am = F.when(h == "am", named).otherwise(F.when(named == "follower", "leader").when(named == "leader", "follower"))
    role = role_of(header, contest, n_columns, position)
    return (
        F.when(h.isin("am", "pro"), F.when(several, one(F.lit("couple"), cell)).when(named.isNotNull(), one(pro_am, cell)).otherwise(none))
        .when(splits, both).when(several, one(F.lit("couple"), cell)).when(role.isNotNull(), one(role, cell)).otherwise(none)
    )


def bib_of(bib: Column, role: Column) -> Column:
    """A bib cell's part for a role: `12/34` holds the leader's and the follower's."""
    parts = F.transform(F.split(bib, "/", 2), lambda p: F.trim(p))
    shared = (F.size(parts) == 2) & (parts[0] != "") & (F.try_element_at(parts, F.lit(2)) != "")
    return F.when(shared & (role == "leader"), parts[0]).when(shared & (role == "follower"), F.try_element_at(parts, F.lit(2))).otherwise(bib)


def place_of(text: Column) -> Column:
    """A printed place as a number: 3 or 3rd; anything else is null."""
    return F.nullif(F.regexp_extract(F.trim(text), r"(?i)^(\d+)(?:st|nd|rd|th)?$", 1), F.lit("")).cast("int")
