"""How printed personal names are read."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.packed import ValueCode, is_packed, learn_codes, shape
from tallyforge.session import bounded_rows, cut

# Words that belong to the surname after them, suffixes, and letters without a decomposition.
PARTICLES = frozenset("de la las los del della di da do dos du des le van der den ten ter von zu zum af av".split())
SUFFIXES = frozenset("jr sr ii iii iv".split())
LETTERS = str.maketrans({"ł": "l", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "æ": "ae", "œ": "oe", "ß": "ss", "ı": "i"})

FORM = ["x", "y", "hx", "hy"]
_BYTES = re.compile("[Â-ô][\u0080-¿]+")
_ASIDE = re.compile(r'\([^()]*\)|\[[^\[\]]*\]|(?<=\S)\s+["“][^"”]*["”]')
_GLUED = re.compile(r"(?<=[^\W\d_A-Z])(?=[A-ZÀ-ÖØ-ÞŁ])")
_NOISE = re.compile(r"[^a-z\-.]")


def repair(text: str) -> str:
    """text with UTF-8 that was read as Latin-1 put right."""
    def back(m: re.Match) -> str:
        try:
            return m.group().encode("latin-1").decode("utf-8")
        except ValueError:
            return m.group()

    return _BYTES.sub(back, text)


def fold(token: str) -> str:
    """A word in plain lower-case letters; hyphens and dots stay."""
    token = unicodedata.normalize("NFKD", token).casefold().translate(LETTERS)
    return _NOISE.sub("", "".join(c for c in token if not unicodedata.combining(c))).strip("-")


def _words(text: str) -> list[str]:
    """Folded words with particles joined by a hyphen to the word after them; an abbreviation ends in `*`."""
    out, lead = [], ""
    for raw in text.split():
        w = fold(raw)
        short = w[-1:] == "." and len(w) > 1
        w = w.replace(".", "")
        if not w or w in SUFFIXES:
            continue
        if w in PARTICLES:
            lead += w
            continue
        out.append((lead + "-" if lead else "") + w + ("*" if short or len(lead + w) == 1 else ""))
        lead = ""
    if lead:
        out.append(lead)
    return out


def _given(words: list[str]) -> str:
    """The given name: the first word, and others but middle initials."""
    rest = [w for w in words[1:] if not (w.endswith("*") and len(w) == 2)]
    return (words[0] if not rest else words[0].rstrip("*") + "".join(r.replace("*", "") for r in rest)).replace("-", "")


def read_name(raw: str) -> tuple[str, str, bool]:
    """(one part, other part, whether they are given name and surname in this order) of a printed name.

    Remarks, called names in quotes, suffixes and middle initials are left out. Where no comma tells, the parts of two
    words come in alphabetical order, but an abbreviation is always the given name. A lone word has an empty other part.
    """
    text = unicodedata.normalize("NFKC", _ASIDE.sub(" ", repair(raw))).replace("...", ".").replace("…", ".")
    if "," in text:
        left, _, right = text.partition(",")
        surname, given = _words(left), _words(right)
        if surname and given:
            return _given(given), "".join(w.rstrip("*") for w in surname), True
        text = left + " " + right
    if not re.search(r"\s", text.strip()):
        text = _GLUED.sub(" ", text)
    words = _words(text)
    if len(words) > 2:
        words = [w for i, w in enumerate(words) if i in (0, len(words) - 1) or not (w.endswith("*") and len(w) == 2)]
    if len(words) > 2:
        words = [words[0], "".join(w.rstrip("*") for w in words[1:])]
    if not words:
        return "", "", False
    if len(words) == 1:
        return words[0].rstrip("*"), "", False
    a, b = words
    if a.endswith("*") != b.endswith("*"):
        return (a.replace("-", ""), b, True) if a.endswith("*") else (b.replace("-", ""), a, True)
    a, b = a.rstrip("*"), b.rstrip("*")
    return (min(a, b), max(a, b), False)


def form_of(a: str, b: str) -> tuple[str, str, str | None, str | None]:
    """The two parts of a name without hyphens in alphabetical order, each with its hyphened spelling if it has one."""
    (x, hx), (y, hy) = sorted(((p.replace("-", ""), p if "-" in p else None) for p in (a, b)), key=lambda t: (t[0], t[1] or ""))
    return x, y, hx, hy


def _read(code: ValueCode | None):
    def run(batches):
        for pdf in batches:
            rows = []
            for raw, n, form in zip(pdf.name_raw, pdf.n, pdf["shape"]):
                if code is not None and is_packed(raw, form, code):
                    continue
                a, b, known = read_name(raw)
                if a or b:
                    rows.append((raw, n, *form_of(a, b), a.replace("-", "") if known and b else None))
            yield pd.DataFrame(rows, columns=["name_raw", "n", *FORM, "given"])

    return run


def single_names(names: DataFrame) -> DataFrame:
    """(name_raw, n, x, y, hx, hy, given) of each distinct name that holds one person: how often it is printed, its form, and
    the given name where the print tells it.

    `names` has name_raw; null and blank names are left out. Fields of several persons are told by the packed-field operator.
    """
    counted = names.filter(F.length(F.trim("name_raw")) > 0).groupBy("name_raw").agg(F.count("*").alias("n"))
    counted = cut(counted.withColumn("shape", shape(F.col("name_raw"))), "printed")
    code = learn_codes(counted.select(F.lit("name").alias("field_name"), "shape")).get("name")
    return counted.mapInPandas(_read(code), "name_raw string, n long, x string, y string, hx string, hy string, given string")


def _starred(c):
    return F.col(c).endswith("*")


def _letters_left_out(c):
    """Keys one of which two words share if one slip parts them: the word and the words that lack one of its letters.

    Words beyond LONG_WORD letters give their first and last letters instead, of which one slip leaves either whole; words
    near that length give both, since a slip may take them across it.
    """
    n = F.length(c)
    none = F.array().cast("array<string>")
    left_out = F.concat(F.array(c), F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, n))))
    ends = F.array(F.concat(F.lit("<"), F.substring(c, 1, LONG_WORD // 3)), F.concat(F.lit(">"), F.substring(c, -(LONG_WORD // 3), LONG_WORD // 3)))
    return F.array_distinct(F.concat(F.when(n <= LONG_WORD + 1, left_out).otherwise(none), F.when(n >= LONG_WORD - 1, ends).otherwise(none)))


def _one_slip(a, b):
    """Whether two words differ by one letter put in, left out or changed, or by two neighbours swapped."""
    letters = lambda c: F.array_sort(F.split(c, ""))
    d = F.levenshtein(a, b, 2)
    return (d == 1) | ((d == 2) & (F.length(a) == F.length(b)) & (letters(a) == letters(b)))


MIN_SLIP = 4  # letters of the shortest word that may hold a slip
MAX_NICKNAMES = 10_000
LONG_WORD = 60  # letters from which a word's slips are looked up by its ends
MAX_START = 2  # letters of the starts that short forms are looked up by
MAX_BARE = 5  # letters of the longest short form without a dot


def word_slips(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """(a, b): words of the sources' names and words of the targets' that are one typing slip apart."""
    def keyed(df: DataFrame, name: str) -> DataFrame:
        words = df.filter("x <> '' and y <> ''").select(F.explode(F.array("x", "y")).alias(name)).filter(~_starred(name) & (F.length(name) >= MIN_SLIP - 1)).distinct()
        return words.select(name, F.explode(_letters_left_out(F.col(name))).alias("key"))

    # Without the hint a table that is small on disk would be broadcast with all its keys, many times its size.
    met = keyed(sources, "a").join(keyed(targets, "b").hint("merge"), "key")
    apart = (F.greatest(F.length("a"), F.length("b")) >= MIN_SLIP) & _one_slip(F.col("a"), F.col("b"))
    return met.filter((F.col("a") != F.col("b")) & apart).select("a", "b").distinct()


def nickname_owners(nicknames: DataFrame) -> dict[str, list[str]]:
    """The owners of each nickname. The table belongs to a language and is small; more than MAX_NICKNAMES is an error."""
    owners: dict[str, list[str]] = {}
    for r in bounded_rows(nicknames.select(F.lower("nickname"), F.lower("canonical")).filter("nickname is not null and canonical is not null").distinct(), MAX_NICKNAMES, "nicknames"):
        owners.setdefault(r[0], []).append(r[1])
    return owners


def _none():
    return F.array().cast("array<string>")


def _only(cond, value):
    return F.when(cond, value).otherwise(_none())


def _owners_of(owners: dict[str, list[str]], c: str):
    if not owners:
        return _none()
    table = F.create_map(*[x for k, v in sorted(owners.items()) for x in (F.lit(k), F.array(*[F.lit(o) for o in sorted(v)]))])
    return F.coalesce(F.try_element_at(table, F.col(c)), _none())


def _start_of(c: str):
    """The first letters by which a short form is looked up."""
    return F.array(F.substring(F.rtrim(F.col(c), F.lit("*")), 1, MAX_START))


def _parts(df: DataFrame, name: str, word: str, other: str) -> DataFrame:
    """Either part of each form as `word` beside the other one, which is no abbreviation."""
    part = lambda w, o, h: F.struct(F.col(w).alias(word), F.col(o).alias(other), F.col(h).alias("h"))
    both = df.filter((F.col("x") != "") & (F.col("y") != "")).select(F.concat_ws("|", "x", "y").alias(name), F.explode(F.array(part("x", "y", "hx"), part("y", "x", "hy"))).alias("p"))
    return both.select(name, "p.*").filter(~_starred(other))


def _keyed(df: DataFrame, other: str, pieces: dict) -> DataFrame:
    """One row per key of each part: the kind, the other part, and a piece of what the word is known by."""
    tag = lambda kind: lambda piece: F.struct(F.lit(kind).alias("kind"), piece.alias("piece"))
    known = F.array_distinct(F.concat(*[F.transform(v, tag(k)) for k, v in pieces.items()]))
    return df.withColumn("k", F.explode(known)).withColumn("key", F.xxhash64("k.kind", other, "k.piece")).withColumn("kind", F.col("k.kind")).drop("k", "h")


def _glue_keys(df: DataFrame, name: str) -> DataFrame:
    """The letters of both parts, whichever comes first."""
    full = df.filter((F.col("x") != "") & (F.col("y") != "") & ~_starred("x") & ~_starred("y"))
    letters = full.select(F.concat_ws("|", "x", "y").alias(name), F.explode(F.array(F.concat("x", "y"), F.concat("y", "x"))).alias("letters"))
    return letters.select(name, F.lit("glued").alias("kind"), F.xxhash64(F.lit("glued"), "letters").alias("key"))


def source_keys(sources: DataFrame, slips: DataFrame, owners: dict[str, list[str]], both: bool = False) -> DataFrame:
    """(form, word, other, two, kind, key): the keys under which forms look for what they may be short, nick, slip, half or glued of."""
    s, full = _parts(sources, "form", "word", "other"), ~_starred("word")
    # Every part is also looked up under the words that its other part may be a slip of.
    meant = s.join(slips.select(F.col("a").alias("other"), F.col("b").alias("means")), "other").select("form", "word", F.col("means").alias("other"), F.lit(True).alias("two"))
    s = s.select("form", "word", "other", F.lit(False).alias("two")).unionByName(meant)
    keys = _keyed(s, "other", {
        "short": _only(_starred("word") | (F.length("word") <= MAX_BARE), _start_of("word")),
        "nick": _only(full, F.concat(F.array("word"), _owners_of(owners, "word")) if both else _owners_of(owners, "word")),
        "long": _only(full, F.array(F.substring("word", 1, MAX_START))) if both else _none(),  # a lone letter is an abbreviation, never a target
        "half": _only(full & (F.length("word") > 2), F.array("word")),
    })
    slipped = s.join(slips.select(F.col("a").alias("word"), F.col("b").alias("piece")), "word").withColumn("kind", F.lit("slip")).withColumn("key", F.xxhash64("kind", "other", "piece")).drop("piece")
    glued = _glue_keys(sources, "form").select("form", F.lit("").alias("word"), F.lit("").alias("other"), F.lit(False).alias("two"), "kind", "key")
    return keys.unionByName(slipped).unionByName(glued)


def target_keys(targets: DataFrame, owners: dict[str, list[str]], both: bool = False) -> DataFrame:
    """(target, t_word, t_other, t_kind, key): the keys under which names are found."""
    t = _parts(targets, "target", "t_word", "t_other").filter(~_starred("t_word"))
    keys = _keyed(t, "t_other", {
        "short": F.array(*[F.substring("t_word", 1, n) for n in range(1, MAX_START + 1)]),
        "nick": F.concat(F.array("t_word"), _owners_of(owners, "t_word")) if both else F.array("t_word"), "slip": F.array("t_word"),
        "long": _only(F.length("t_word") <= MAX_BARE, _start_of("t_word")) if both else _none(),
        "half": F.coalesce(F.split("h", "-"), _none()),
    }).withColumnRenamed("kind", "t_kind")
    glued = _glue_keys(targets, "target").select("target", F.lit("").alias("t_word"), F.lit("").alias("t_other"), F.col("kind").alias("t_kind"), "key")
    return keys.unionByName(glued)


def meet(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """(form, target, kind, a, b, two): the forms of source_keys that fit the names of target_keys, with the two words they differ in."""
    start = F.rtrim(F.col("word"), F.lit("*"))
    fits = (
        F.when(F.col("kind") == "short", F.col("t_word").startswith(start))
        .when(F.col("kind") == "long", F.col("word").startswith(F.col("t_word")))
        .otherwise(True)
    )
    differ = F.when(F.col("kind") == "glued", F.col("form") != F.col("target")).otherwise((F.col("other") == F.col("t_other")) & (F.col("word") != F.col("t_word")) & fits)
    met = sources.join(targets, "key").filter((F.col("kind") == F.col("t_kind")) & differ)
    return met.groupBy("form", "target", F.col("word").alias("a"), F.col("t_word").alias("b")).agg(F.min("kind").alias("kind"), F.min("two").alias("two")).select("form", "target", "kind", "a", "b", "two")


def form_pairs(sources: DataFrame, targets: DataFrame, nicknames: DataFrame, slips: DataFrame, both: bool = False) -> DataFrame:
    """(form, target, kind, a, b, two): forms of one person perhaps, with the two words they differ in.

    Kinds: short (a given name's first letters), nick (a nickname and its owner), slip (one typing slip in one part), half
    (one half of a double name, or a surname without its particles), glued (the same letters, divided otherwise between the
    parts); if `both`, also long (the target is the short form) and nick either way. The other parts are
    equal, or, where `two` is true, one typing slip apart as well. Everything meets in one join on whole keys, each the
    target's other part together with what its word is known by: its first letters, a nickname's owner, itself, or a half.
    Both tables have x, y, hx, hy; `slips` has the word_slips that count.
    """
    owners = nickname_owners(nicknames)
    # Without the hint a table that is small on disk would be broadcast with all its keys, many times its size.
    return meet(source_keys(sources, slips, owners, both), target_keys(targets, owners, both).hint("merge"))


MIN_BEARERS, MIN_SHARE, MIN_LIFT = 8, 0.4, 5.0  # surnames a nickname must be seen with, the share its owner must be seen with too, and that share against the owner's usual one
SALT_OWNERS, MAX_SALTS = 1_000, 1_000  # given names of a surname from which its pairs are spread over several tasks, and how many at most


def learned_nicknames(names: DataFrame) -> DataFrame:
    """(nickname, canonical): given names whose bearers nearly all appear under one commoner given name, too.

    A nickname that no table lists shows in the company it keeps: most surnames printed with it are printed with its owner.
    Only its best owner is taken, and plain short forms are left to the rule for them.
    Any given name with twice the surnames may be an owner. A surname of very many given names is spread over salts, one
    for every SALT_OWNERS of them, so that no task pairs them all. Words count as given names where prints that tell the order say so.
    """
    told = names.filter("given is not null").select("given", F.when(F.col("x") == F.rtrim("given", F.lit("*")), F.col("y")).when(F.col("given") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("surname"))
    sides = told.select(F.explode(F.array(F.struct(F.col("given").alias("word"), F.lit(1).alias("v")), F.struct(F.col("surname").alias("word"), F.lit(-1).alias("v")))).alias("s")).select("s.*")
    given = sides.groupBy("word").agg(F.sum("v").alias("v")).filter("v > 0").select("word")
    full = names.filter("x <> '' and y <> '' and not x like '%*' and not y like '%*'").select("x", "y").distinct()
    seen = full.select(F.explode(F.array(F.struct(F.col("x").alias("word"), F.col("y").alias("other")), F.struct(F.col("y").alias("word"), F.col("x").alias("other")))).alias("s")).select("s.*").join(given, "word")
    bearers = seen.groupBy("word").agg(F.count("*").alias("d")).filter(F.col("d") >= MIN_BEARERS)
    borne = seen.join(bearers, "word")
    salts = F.least(F.lit(MAX_SALTS), F.ceil(F.count("*") / SALT_OWNERS)).cast("int")
    borne = borne.join(borne.groupBy("other").agg(salts.alias("salts")), "other")
    a = borne.select("other", F.col("word").alias("nickname"), "d", F.pmod(F.hash("word"), "salts").alias("salt"))
    b = borne.filter(F.col("d") >= 2 * MIN_BEARERS).select("other", F.col("word").alias("canonical"), F.col("d").alias("d_owner"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    n = seen.select(F.approx_count_distinct("other").alias("n_surnames"))
    met = a.join(b, ["other", "salt"]).filter((F.col("d_owner") >= 2 * F.col("d"))).groupBy("nickname", "canonical", "d", "d_owner").agg(F.count("*").alias("both"))
    share = F.col("both") / F.col("d")
    best = met.groupBy("nickname", "d").agg(F.max(F.struct("both", "d_owner", "canonical")).alias("m")).select("nickname", "d", "m.*").filter(~F.col("canonical").startswith(F.col("nickname")))
    return best.filter(share >= MIN_SHARE).join(n).filter(share >= MIN_LIFT * F.col("d_owner") / F.col("n_surnames")).select("nickname", "canonical")
