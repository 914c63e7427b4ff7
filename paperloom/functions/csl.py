"""Records in the citation style language, and BibTeX entries filled by the fields that their kind has."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.reference import scalar, year

#: Fields that each kind of entry may have besides those it must have (fixed values).
OPTIONAL = {
    "article": "volume number pages month note", "book": "volume number series address edition month note", "booklet": "author howpublished address month year note",
    "conference": "editor volume number series pages address month organization publisher note", "electronic": "author year note", "inbook": "volume number series type address edition month note",
    "incollection": "editor volume number series type chapter pages address edition month note", "inproceedings": "editor volume number series pages address month organization publisher note",
    "manual": "author organization address edition month year note", "mastersthesis": "type address month note", "misc": "author title howpublished month year note",
    "periodical": "editor series volume number note", "phdthesis": "type address month note", "proceedings": "editor volume number series address month organization publisher note",
    "techreport": "type number address month note", "unpublished": "month year",
}


def _first(v: Column, *paths: str) -> Column:
    return F.coalesce(*(scalar(v, p) for p in paths))


def people(v: Column) -> Column:
    """Authors as given and family names: from parts, from one name, or from a text whose last word is the family (O1)."""
    def one(a: Column) -> Column:
        text = F.try_variant_get(a, "$", "string")
        given, family, name = (F.try_variant_get(a, f"$.{k}", "string") for k in ("given", "family", "name"))
        words = F.split(F.trim(text), r"\\s+")
        last, rest = F.element_at(words, -1), F.array_join(F.slice(words, 1, F.size(words) - 1), " ")
        is_object = F.schema_of_variant(a).startswith("OBJECT")
        parts = F.when(given.isNull() & family.isNull(), F.struct(F.lit("").alias("given"), name.alias("family"))).when(
            family.isNull(), F.struct(F.lit("").alias("given"), given.alias("family"))
        ).otherwise(F.struct(F.coalesce(given, F.lit("")).alias("given"), family.alias("family")))
        return F.when(is_object, parts).otherwise(F.struct(rest.alias("given"), last.alias("family")))

    made = F.filter(F.transform(F.try_variant_get(v, "$.author", "array<variant>"), one), lambda p: p["family"].isNotNull())
    return F.when(F.size(made) > 0, made)


def csl(v: Column) -> Column:
    """A record as a struct of type, title, author, container_title, volume, page and issued year (O1, O2).

    The type is Article where none is given. The date is read where date parts are there, else from the year.
    """
    return F.struct(
        F.coalesce(_first(v, "type", "publicationtypes"), F.lit("Article")).alias("type"), scalar(v, "title").alias("title"), people(v).alias("author"),
        _first(v, '["container-title"]', "container_title", "journal", "booktitle").alias("container_title"), _first(v, "volume", "journal_volume", "journal.volume").alias("volume"),
        _first(v, "page", "journal_page", "journal.number", "journal.page").alias("page"), year(v).alias("issued"),
    )


def kept_fields(kind: Column, fields: Column, required: dict[str, str]) -> Column:
    """The fields of an entry that its kind has, and the publisher with its address as one."""
    names = F.create_map(*(F.lit(x) for k in OPTIONAL for x in (k, f"{required[k]} {OPTIONAL[k]}".replace("/", " "))))
    own = F.split(F.coalesce(F.element_at(names, kind), F.element_at(names, F.lit("misc"))), " ")
    held = F.map_filter(fields, lambda k, v: F.array_contains(own, k) & (F.trim(v) != ""))
    place = F.concat_ws(", ", F.element_at(fields, F.lit("publisher")), F.element_at(fields, F.lit("address")))
    return F.when(F.map_contains_key(held, F.lit("publisher")), F.map_concat(F.map_filter(held, lambda k, _: k != "publisher"), F.create_map(F.lit("publisher"), place))).otherwise(held)
