"""References: one canonical form from records of many shapes, and predicates on it.

Records come as VARIANT (``parse_json``), so a field may be a string in one row and an array
of objects in the next. Missing means null, empty or blank.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of identifier kinds and of prefixes that their values may carry (fixed values).
ID_KINDS = ("doi", "openalex", "pubmed", "semopenalex", "arxiv", "pmc", "dblp", "mag", "pii", "acl")
ID_ALIASES = {"pm": "pubmed", "pmid": "pubmed", "pubmedcentral": "pmc", "pmcid": "pmc", "arxiv_id": "arxiv", "open_alex_id": "openalex"}
ID_PREFIX = r"(?i)^\s*(?:https?://)?(?:dx\.|www\.)?(?:doi\.org/|arxiv\.org/abs/|openalex\.org/|semopenalex\.org/work/|pubmed\.ncbi\.nlm\.nih\.gov/|arxiv:|doi:)\s*"
#: Places of each field, in order of preference (fixed values).
PATHS = {
    "title": ("title",),
    "journal": ("journal", "jname", "journal_name", '["container-title"]', "j_name", "imprint.journal", "publisher"),
    "journal_volume": ("journal_volume", "jvol", "volume", "imprint.volume", "journal.volume"),
    "journal_page": ("journal_page", "jpage", "page", "pages", "imprint.page", "journal.pages"),
    "publisher": ("publisher",),
    "content": ("content", "citation", "short_content"),
}


def _path(p: str) -> str:
    return f"${p}" if p.startswith("[") else f"$.{p}"


def scalar(v: Column, path: str) -> Column:
    """A place of a record as text: the first element of arrays, the name of objects, null if blank."""
    at = _path(path)
    own = F.try_variant_get(v, f"{at}", "string")
    first = F.try_variant_get(v, f"{at}[0]", "string")
    named = F.coalesce(F.try_variant_get(v, f"{at}.name", "string"), F.try_variant_get(v, f"{at}[0].name", "string"))
    kind = F.schema_of_variant(F.try_variant_get(v, at, "variant"))
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    text = F.when(F.coalesce(nested, F.lit(False)), F.coalesce(named, first)).otherwise(own)
    return F.nullif(F.trim(text), F.lit(""))


def field(v: Column, name: str) -> Column:
    """A field of the canonical form."""
    return F.coalesce(*(scalar(v, p) for p in PATHS[name]))


def title(v: Column) -> Column:
    """The title; one word of less than three letters is none."""
    t = field(v, "title")
    return F.when(~(F.size(F.split(t, r"\s+")) <= 1) | (F.length(t) >= 3), t)


def year(v: Column) -> Column:
    """The year, wherever a date is written."""
    text = F.coalesce(
        *(scalar(v, p) for p in ("year", "date")),
        F.try_variant_get(v, '$.issued["date-parts"][0][0]', "string"), *(scalar(v, p) for p in ("imprint.date", "issued")),
    )
    return F.nullif(F.regexp_extract(text, r"(?<!\d)(\d{4})(?!\d)", 1), F.lit("")).try_cast("int")


#: Words that join what follows them to a surname, and what may follow a name (fixed values).
PARTICLES = "de del della der den di da dos du la le van von ter ten bin ibn al el zu zum zur st"
SUFFIXES = "jr sr ii iii iv v phd md esq"


def short_name(name: Column) -> Column:
    """A full name as initials and surname.

    One word stays. What stands after a comma is given names, or a suffix, which goes; particles
    before the last word belong to the surname.
    """
    flat = F.trim(F.regexp_replace(name, r"\s+", " "))
    suffix = rf"(?i),?\s+(?:{'|'.join(SUFFIXES.split())})\.?$"
    plain = F.regexp_replace(flat, suffix, "")
    turned = F.when(plain.contains(","), F.regexp_replace(plain, r"^([^,]+),\s*(.+)$", "$2 $1")).otherwise(plain)
    last = F.regexp_extract(turned, rf"(?i)((?:\b(?:{'|'.join(PARTICLES.split())})\s+)*\S+)$", 1)
    given = F.filter(F.split(F.trim(F.left(turned, F.length(turned) - F.length(last))), " "), lambda g: g != "")
    initials = F.array_join(F.transform(given, lambda g: F.concat(F.upper(F.left(g, F.lit(1))), F.lit("."))), " ")
    return F.when(~turned.contains(" "), turned).when(F.size(given) == 0, last).when(name.isNotNull(), F.concat_ws(" ", initials, last))


def authors(v: Column, most: int = 3) -> Column:
    """Short names of the first authors, from texts, given and family names, or one text."""
    def one(a: Column) -> Column:
        text = F.try_variant_get(a, "$", "string")
        given = F.coalesce(*(F.try_variant_get(a, f"$.{k}", "string") for k in ("given", "first", "forename", "name")))
        family = F.coalesce(*(F.try_variant_get(a, f"$.{k}", "string") for k in ("family", "last", "surname")))
        is_object = F.schema_of_variant(a).startswith("OBJECT")
        return short_name(F.when(is_object, F.concat_ws(" ", given, family)).otherwise(text))

    listed = F.coalesce(F.try_variant_get(v, "$.author", "array<variant>"), F.try_variant_get(v, "$.authors", "array<variant>"))
    text = F.coalesce(F.try_variant_get(v, "$.author", "string"), F.try_variant_get(v, "$.authors", "string"))
    split = F.transform(F.split(text, r"\s*,\s*|\s+and\s+"), short_name)
    # an author given literally may be several, whose names stay as they are
    literal = F.transform(listed, lambda a: F.split(F.try_variant_get(a, "$.literal", "string"), r"\s*,\s*|\s+and\s+"))
    each = F.flatten(F.transform(F.arrays_zip(literal.alias("l"), F.transform(listed, one).alias("o")), lambda z: F.coalesce(z["l"], F.array(z["o"]))))
    named = F.when(listed.isNotNull(), each).otherwise(split)
    kept = F.slice(F.filter(named, lambda x: F.coalesce(F.trim(x), F.lit("")) != ""), 1, most)
    return F.when(F.size(kept) > 0, kept)


def identifiers(m: Column) -> Column:
    """A map of identifiers with canonical names and bare values; blank ones and others go."""
    def kind(k: Column, _: Column) -> Column:
        low = F.lower(F.trim(k))
        out = low
        for alias, name in ID_ALIASES.items():
            out = F.when(low == alias, F.lit(name)).otherwise(out)
        return out

    bare = F.transform_values(m, lambda _, x: F.nullif(F.trim(F.regexp_replace(x, ID_PREFIX, "")), F.lit("")))
    known = F.map_filter(bare, lambda k, x: kind(k, x).isin(*ID_KINDS) & x.isNotNull())
    pairs = F.transform(F.map_entries(known), lambda e: F.struct(kind(e["key"], e["value"]).alias("key"), e["value"].alias("value")))
    # of several values under one canonical name the first by the name it was given holds
    firsts = F.filter(
        F.sequence(F.lit(0), F.size(pairs) - 1),
        lambda i: F.array_position(F.transform(pairs, lambda p: p["key"]), F.get(pairs, i)["key"]) == i + 1,
    )
    return F.when(F.size(pairs) > 0, F.map_from_entries(F.transform(firsts, lambda i: F.get(pairs, i.cast("int")))))


def same_ids(a: Column, b: Column) -> Column:
    """Whether two identifier maps share a value of one kind."""
    hits = F.filter(F.map_keys(a), lambda k: F.element_at(a, k) == F.element_at(b, k))
    return F.coalesce(F.size(hits) > 0, F.lit(False))


def canonical(v: Column, ids: Column | None = None) -> Column:
    """The nine fields of a reference."""
    unique = identifiers(F.coalesce(*(F.try_variant_get(v, f"$.{k}", "map<string,string>") for k in ("unique_id", "externalids")))) if ids is None else ids
    return F.struct(
        unique.alias("unique_id"), title(v).alias("title"), authors(v).alias("author"), field(v, "journal").alias("journal"),
        field(v, "journal_volume").alias("journal_volume"), field(v, "journal_page").alias("journal_page"),
        year(v).alias("year"), field(v, "publisher").alias("publisher"), field(v, "content").alias("content"),
    )


def filled(old: Column, new: Column, fields: tuple[str, ...]) -> Column:
    """The old record with what it lacks taken from the new one, and whether that changed it."""
    changed = F.lit(False)
    for f in fields:
        changed = changed | (old[f].isNull() & new[f].isNotNull())
    return F.struct(*(F.coalesce(old[f], new[f]).alias(f) for f in fields), changed.alias("changed"))


def worth_keeping(r: Column) -> Column:
    """Whether a reference says enough to be put into an index."""
    has = {f: r[f].isNotNull() for f in ("title", "author", "journal", "journal_volume", "journal_page", "year")}
    by_place = has["journal"] & has["journal_volume"] & has["journal_page"] & has["year"]
    return has["title"] | (has["author"] & has["journal"] & has["year"]) | by_place


def flattened(r: Column, most: int = 3) -> list[Column]:
    """A reference as flat columns, authors numbered."""
    plain = ("title", "journal", "journal_volume", "journal_page", "year", "publisher", "content")
    return [*(r[f].alias(f) for f in plain), *(F.get(r["author"], i).alias(f"author_{i}") for i in range(most))]


def recommended_ids(v: Column) -> Column:
    """Identifiers of a recommended entry: its own, the registered DOI, and the first preprint it contains."""
    own = F.coalesce(F.try_variant_get(v, "$.ids", "map<string,string>"), F.create_map().cast("map<string,string>"))
    more = F.map_from_arrays(F.array(F.lit("doi"), F.lit("arXiv")), F.array(scalar(v, "crossref_doi"), F.try_variant_get(v, "$.contained_arXiv_ids[0].id", "string")))
    more = F.map_filter(more, lambda _, x: x.isNotNull())
    return F.map_concat(F.map_filter(own, lambda k, _: ~F.map_contains_key(more, k)), more)
