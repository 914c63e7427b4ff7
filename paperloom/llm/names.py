"""Variant spellings of names: metric-space partitioning with exact radius joins.

Each distinct name is parsed once into a block (first initial, or collaboration), a folded
surname and a given name. Given names that stand for each other (nicknames) are learnt from
citations that carry both with one surname. The distinct surnames are partitioned in the edit
metric: the pivots are the strings that some surname becomes by as many deletions as the radius
allows, and a surname is replicated to every pivot that near. Two surnames within the radius
share such a pivot, so an exact radius join inside the cells loses no pair, wherever the edits
are. Pivots taken from the surnames themselves prune nothing (README has the figures).

Surnames that are rare next to a close and better supported one, and whose given names do not
contradict it, are misspellings of it; names of one block and resolved surname are one entity.

Defined results
---------------
* Null, empty and blank strings and "et al." are no names. Strings are kept exactly as stored.
* Repeated rows add support only. Ties go to the better supported, then the smaller surname.
* A string without letters forms an entity of its own. Empty tables and arrays give no rows.
* Very long strings are treated like others: long surnames meet by equal segments, exactly too.
* Rows without paper or place teach no nicknames, but their names count.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.survivor import paper_key
from paperloom.session import persist_table

#: Words before a surname, and signs after a name (fixed values).
PARTICLES = frozenset("de del della den der di da du la le van von ter ten dos das bin al el zu zum zur".split())
SUFFIXES = frozenset("jr sr ii iii iv".split())
#: Letters that do not decompose (fixed values).
LETTERS = str.maketrans({"ø": "o", "đ": "d", "ł": "l", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i", "þ": "th", "ð": "d"})
_NO_SURNAME = frozenset(("collaboration", "coll", "collab", "collaborations", "collabs"))
_TEX = re.compile(r"\\(?:[\"'`^~=.]|[uvHckrdb](?![A-Za-z]))\s*\{?\\?([A-Za-z])\}?")
_TEX_LETTER = re.compile(r"\{?\\(aa|AA|o|O|l|L|ss|ae|AE|oe|OE|i|j)\b\}?\s?")
_COLLAB = re.compile(r"\bcoll(?:ab(?:oration)?s?)?\b\.?", re.I)


def fold(text: str) -> str:
    """Lower case without accents, written as signs or as TeX commands."""
    if "\\" in text:
        text = _TEX_LETTER.sub(lambda m: m[1], _TEX.sub(r"\1", text))
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", text.lower().translate(LETTERS))
    return "".join(c for c in text if not unicodedata.combining(c))


def _letters(text: str) -> str:
    return "".join(c for c in text if c.isalpha())


#: The plainest form: a given name or initial, further initials, a surname in ASCII letters.
_PLAIN = re.compile(r"([A-Z])([a-z]*)(\.?) (?:[A-Z]\. )*([A-Z][a-z]{3,})")


def parse(name: str) -> tuple[str, str, str]:
    """(block, surname key, given name or initials) of a name; the block is the first initial, # for a collaboration."""
    m = _PLAIN.fullmatch(name)
    if m and bool(m[2]) != bool(m[3]) and m[4].lower() not in _NO_SURNAME:
        given = (m[1] + m[2]).lower()
        return given[0], m[4].lower(), given
    flat = " ".join(name.split())
    if _COLLAB.search(flat):
        key = _letters(fold(re.sub(r"\bthe\b", " ", _COLLAB.sub(" ", flat), flags=re.I)))
        return ("#", key, "") if key else ("?", flat, "")
    family, comma, given = flat.partition(",")
    if comma:
        head = [t for t in re.split(r"[\s.]+", given) if t and t.lower().strip(".,") not in SUFFIXES and t != ","]
        if not head and _letters(family):  # "First Last, Jr."
            return parse(family)
        given_tokens = [t.strip(",") for t in head]
        family_tokens = family.split()
    else:
        tokens = re.sub(r"\.(?=\S)", ". ", flat).split()
        tokens = [t for t in tokens if t.lower().strip(".,") not in SUFFIXES] or tokens
        moved = []
        while len(tokens) > 2 and tokens[-1] in PARTICLES:
            moved.insert(0, tokens.pop())
        if len(tokens) > 1 and re.fullmatch(r"[A-Z]{1,3}", tokens[-1]) and all(len(_letters(t)) > 1 for t in tokens[:-1]):
            given_tokens, family_tokens = list(tokens[-1]), tokens[:-1]  # "Surname AB"
        else:
            at = len(tokens) - 1
            first = next((i for i in range(1, len(tokens)) if tokens[i].lower() in PARTICLES), None)
            if first is not None:
                at = first
            elif len(tokens) > 2 and all(len(_letters(t)) == 1 for t in tokens[:-2]) and len(_letters(tokens[-2])) > 1:
                at = len(tokens) - 2  # initials, then a surname of two words
            given_tokens, family_tokens = tokens[:at], [*moved, *tokens[at:]]
    trailing = [t for t in given_tokens if t.lower().strip(".") not in PARTICLES]
    key = _letters("".join(fold(t) for t in family_tokens if fold(t).strip(".") not in PARTICLES)) or _letters(fold(family))
    first = _letters(fold(trailing[0])) if trailing else ""
    return (first[:1] or "-", key, first) if key else ("?", flat, "")


NAMES = "name string, n bigint, block string, skey string, given string"


def distinct_names(graded: DataFrame, column: str = "candidate.author", first: int = 2) -> DataFrame:
    """Each distinct name among the first authors, parsed once, with the number of its rows."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parsed = pd.DataFrame([parse(x) for x in pdf["name"]], columns=["block", "skey", "given"], index=pdf.index)
            yield pd.concat([pdf, parsed], axis=1)

    names = graded.select(F.explode(F.slice(column, 1, first)).alias("name"))
    named = names.where("name is not null and trim(name) not in ('', 'et al.')")
    return named.groupBy("name").agg(F.count("*").alias("n")).mapInPandas(run, NAMES)


def edits(a: str, b: str, most: int) -> int:
    """Damerau-Levenshtein distance with unrestricted transpositions, a true metric; most + 1 if beyond ``most``.

    Only places up to ``most`` aside are looked at, for others are further apart than that; a
    transposition skips ``most`` rows at most, so after more rows without a near place none comes.
    """
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    far = most + 1
    if abs(len(a) - len(b)) > most:
        return far
    last, lost = {}, 0
    rows = [[far] * (len(b) + 2), [far, *range(len(b) + 1)]]
    for i, x in enumerate(a, 1):
        row, above, seen = [far] * (len(b) + 2), rows[i], 0
        row[1] = i
        start, end = max(1, i - most), min(len(b), i + most)
        for j in range(start, end + 1):
            y = b[j - 1]
            best = min(above[j] + (x != y), row[j] + 1, above[j + 1] + 1)
            k = last.get(y, 0)
            if seen and k and i - k <= most:
                best = min(best, rows[k][seen] + i - k + j - seen - 1)
            row[j + 1] = best
            if x == y:
                seen = j
        lost = lost + 1 if min(row[start : end + 2]) > most else 0
        if lost > most:
            return far
        last[x] = i
        rows.append(row)
        if i >= most:
            rows[i - most] = []
    return min(rows[-1][-1], far)


#: Letters up to which a surname meets others at the pivots of its deletions, and from which by its segments.
BY_DELETION, BY_SEGMENT = 24, 23
#: Segments of a long surname: two edits, transpositions over a border among them, leave one of five whole.
SEGMENTS = 5


def allowed_edits(length: Column) -> Column:
    """Edits that a surname of this length may be off: none up to two letters, one up to four, else two."""
    return F.when(length <= 2, 0).when(length <= 4, 1).otherwise(2)


def _less_one(x: Column) -> Column:
    """All strings that a text becomes by one deletion."""
    return F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.left(x, i - 1), F.substring(x, i + 1, F.length(x))))


def deletion_pivots(skey: Column) -> Column:
    """The pivots of a surname: what it becomes by as many deletions as it may be off."""
    one = F.when(F.length(skey) > 2, _less_one(skey)).otherwise(F.array().cast("array<string>"))
    two = F.when(F.length(skey) > 4, F.flatten(F.transform(one, _less_one))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(skey), one, two))


def _segment_keys(skey: Column, length: Column, shift: int) -> Column:
    """What a surname has, up to ``shift`` places aside, where one of ``length`` has its segments."""
    shifts = F.sequence(F.lit(-shift), F.lit(shift)) if shift else F.array(F.lit(0))

    def of(k: Column) -> Column:
        start, end = (F.floor(length * j / SEGMENTS).cast("int") for j in (k, k + 1))
        return F.transform(shifts, lambda d: F.xxhash64(length, k, F.substring(skey, start + 1 + d, end - start)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(SEGMENTS - 1)), of))


def cells(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cells that own each surname, and those that it is replicated to: (skey, cell), (other, cell)."""
    n = F.length("skey")
    near = keys.where(n <= BY_DELETION).select("skey", F.explode(F.transform(deletion_pivots(F.col("skey")), lambda p: F.xxhash64(p))).alias("cell"))
    long = keys.where(n >= BY_SEGMENT)
    own = long.select("skey", F.explode(_segment_keys(F.col("skey"), n, 0)).alias("cell"))
    lengths = F.sequence(n - 2, n + 2)
    visits = F.array_distinct(F.flatten(F.transform(lengths, lambda x: _segment_keys(F.col("skey"), x, 2))))
    seen = long.select("skey", F.explode(visits).alias("cell"))
    return near.unionByName(own), near.unionByName(seen).withColumnRenamed("skey", "other")


def radius_join(keys: DataFrame) -> DataFrame:
    """All ordered pairs of different surnames within :func:`allowed_edits` of the shorter: skey, other, distance.

    Exact, for surnames of any length. ``keys`` has distinct skey. In a cell pairs first pass bounds
    by length and by the Levenshtein distance, which is at most twice the one with transpositions.
    The cells are up to three hundred times the surnames that the optimizer goes by, so they are never broadcast.
    """
    owners, members = cells(keys)
    reach = allowed_edits(F.least(F.length("skey"), F.length("other")))
    meet = (
        (F.col("skey") < F.col("other"))
        & (F.abs(F.length("skey") - F.length("other")) <= reach)
        & (F.expr("levenshtein(skey, other, 4)") >= 0)
    )
    either = owners.join(members.hint("merge"), "cell").select(F.least("skey", "other").alias("skey"), F.greatest("skey", "other").alias("other"))
    near = either.where(meet).distinct().withColumn("reach", reach)

    def measured(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.assign(distance=[edits(a, b, r) for a, b, r in zip(pdf["skey"], pdf["other"], pdf["reach"], strict=True)])
            yield pdf.loc[pdf["distance"] <= pdf["reach"], ["skey", "other", "distance"]]

    found = near.mapInPandas(measured, "skey string, other string, distance int")
    both = F.array(F.struct("skey", "other"), F.struct(F.col("other").alias("skey"), F.col("skey").alias("other")))
    return found.select(F.explode(both).alias("p"), "distance").select("p.*", "distance")


#: Surnames on which a nickname must be met beside what it stands for.
TAUGHT_BY = 2


def nicknames(graded: DataFrame, names: DataFrame, column: str = "candidate.author", first: int = 2) -> DataFrame:
    """Given names that stand for longer ones: given, full.

    Rows of one citation name the same people, so two given names at one place of it with one surname
    are one person's; those met on :data:`TAUGHT_BY` surnames, the longer neither written out from nor
    a misspelling of the other, are held to be nickname and full name.
    """
    rows = graded.select(paper_key("paper_id").alias("paper"), "pos", F.posexplode(F.slice(column, 1, first)).alias("slot", "name"))
    spelt = rows.where("paper is not null and pos is not null and name is not null").distinct()
    given = spelt.join(names.where("length(given) > 1").select("name", "skey", "given").hint("merge"), "name")
    said = given.select("paper", "pos", "slot", "skey", "given").distinct()
    place = Window.partitionBy("paper", "pos", "slot", "skey")
    longest = F.max(F.struct(F.length("given").alias("n"), "given")).over(place)["given"]
    pairs = said.withColumn("full", longest).where(~F.col("full").startswith(F.col("given")) & (F.levenshtein("given", "full") > 2))
    votes = pairs.select("given", "full", "skey").distinct().groupBy("given", "full").agg(F.count("*").alias("votes"))
    taught = votes.where(F.col("votes") >= TAUGHT_BY).groupBy("given").agg(F.max(F.struct("votes", "full"))["full"].alias("full"))
    return _to_the_root(taught, ["given"], "full")


def _to_the_root(parent: DataFrame, key: Sequence[str], to: str) -> DataFrame:
    """The last of the steps from each key, the last column of which ``to`` takes the place of, by pointer jumping.

    Steps go to what is greater by a fixed order, so there are no circles; each round doubles those taken.
    """
    *same, last = key
    parent = persist_table(parent, "roots")
    while True:
        further = parent.select(*same, F.col(last).alias(to), F.col(to).alias("next"))
        step = persist_table(parent.join(further.hint("merge"), [*same, to], "left"), "roots")
        parent = step.select(*key, F.coalesce("next", to).alias(to))
        if not step.where("next is not null").take(1):
            return parent


def with_full_names(names: DataFrame, nicks: DataFrame) -> DataFrame:
    """Names whose nicknames are written out, with the block of the full name."""
    full = F.coalesce("full", "given")
    block = F.when(F.col("block").isin("#", "?", "-"), F.col("block")).otherwise(F.left(full, F.lit(1)))
    return names.join(nicks.hint("merge"), "given", "left").select("name", "n", block.alias("block"), "skey", full.alias("given"))


def _agree(a: Column, b: Column) -> Column:
    """Whether two given names may be one person's: unknown, short for the other, or misspelt."""
    return F.coalesce(a.startswith(b) | b.startswith(a) | (F.levenshtein(a, b, 2) >= 0), F.lit(True))


def resolve(names: DataFrame) -> DataFrame:
    """Misspelt surnames and what they stand for: block, skey, root. Surnames that stand for themselves are left out.

    Of two close surnames of one block the one with fewer spellings (then rows) is the misspelt
    one, unless both are well supported or their given names contradict; it stands for its
    closest, then best supported neighbour. A slip in the first letter needs more support.
    """
    spoken = F.when(F.length("given") > 2, F.struct(F.col("n"), F.col("given")))
    keys = persist_table(
        names.where("block <> '?'").groupBy("block", "skey")
        .agg(F.count("*").alias("forms"), F.sum("n").alias("n"), F.max(spoken)["given"].alias("given")),
        "surnames",
    )
    near = persist_table(radius_join(keys.select("skey").distinct()), "near")
    one, two = (
        keys.select("block", F.col("skey").alias(k), F.struct("forms", "n", F.col("skey")).alias(w), F.col("given").alias(g))
        for k, w, g in (("skey", "w", "given"), ("other", "w_o", "given_o"))
    )
    pairs = near.join(one.hint("merge"), "skey").join(two.hint("merge"), ["block", "other"])
    first = F.left("skey", F.lit(1)) == F.left("other", F.lit(1))
    misspelt = (
        (F.col("distance") <= F.when(F.col("block") == "#", 1).otherwise(2))
        & (F.col("w_o") > F.col("w"))
        & ((F.col("w.forms") < DISTINCT_FORMS) | (F.col("w_o.forms") >= 4 * F.col("w.forms")))
        & (first | ((F.col("distance") == 1) & (F.col("w_o.forms") >= 4 * F.col("w.forms")) & (F.col("block") != "#")))
        & _agree(F.col("given"), F.col("given_o"))
    )
    parent = (
        pairs.where(misspelt)
        .groupBy("block", "skey")
        .agg(F.min(F.struct("distance", (-F.col("w_o.forms")).alias("f"), (-F.col("w_o.n")).alias("m"), "other"))["other"].alias("root"))
    )
    return _to_the_root(parent, ["block", "skey"], "root")  # support grows along the way


#: Spellings from which a surname is held to be a name of its own.
DISTINCT_FORMS = 4


def entities(graded: DataFrame) -> DataFrame:
    """Every name with its entity and the entity's best supported name: name, n, entity, representative."""
    parsed = persist_table(distinct_names(graded), "names")
    names = persist_table(with_full_names(parsed, nicknames(graded, parsed)), "names")
    key = F.coalesce("root", "skey")
    found = names.join(resolve(names).hint("merge"), ["block", "skey"], "left").select("name", "n", F.concat_ws(" ", "block", key).alias("entity"))
    best = Window.partitionBy("entity")
    return found.withColumn("representative", F.max(F.struct("n", "name")).over(best)["name"])


def linked_pairs(graded: DataFrame) -> DataFrame:
    """Pairs of different spellings of one entity: name_a, name_b, the smaller first in byte order."""
    found = persist_table(entities(graded).select("name", "entity"), "entities")
    a, b = found.select("entity", F.col("name").alias("name_a")), found.select("entity", F.col("name").alias("name_b"))
    return a.join(b.hint("merge"), "entity").where("name_a < name_b").select("name_a", "name_b")
