"""Best representative of each duplicate group: Bayesian fusion with copy detection.

A group holds the rows of one paper and one place. Every engine makes one claim per field of a
group, the value it gives most often however spelt (of two, the one retrieved last). How the claims of the engines agree is all that the
model needs, so items are counted by that pattern (at most 52 for four engines) and the
expectation-maximisation runs over the counts: accuracies of engines, the share of claims that an
engine copies from another (from shared false values), votes that copies do not add to, and the value
of highest posterior probability for each pattern. The surviving record is the row ranked first,
with each field at that value.

Defined results
---------------
* Rows without paper or place belong to no group. Null and empty values make no claim.
* A null candidate has no fields and no score. Ties end with the smallest graded_id.
* Repeated rows add support to their engine's value only. An empty table gives an empty table.
"""

from __future__ import annotations

from itertools import combinations
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.session import persist_table

#: Fields of a candidate that are fused and whose presence counts as completeness (fixed values).
FIELDS = ("doi", "arxiv", "dblp", "mag", "pubmed", "title", "journal", "journal_volume", "journal_page", "year", "publisher")
#: Engines in order of preference; whatever else is typed is "other" (fixed values).
ENGINES = ("anystyle", "grobid", "plain_text", "other")
KEY = ("paper_key", "pos")
#: Rows of one engine in one group from which its votes are counted by shuffles and not in one place (at most rows / HOT_ROWS such).
HOT_ROWS = 1_000


def paper_key(paper_id: str | Column) -> Column:
    """A paper id however typed: without prefix or address, version, case and outer blanks, with a slash for an underscore."""
    x = F.lower(F.trim(F.col(paper_id) if isinstance(paper_id, str) else paper_id))
    x = F.translate(x, "_", "/")
    x = F.regexp_replace(x, r"^(?:https?://)?(?:www\.)?(?:arxiv\.org/(?:abs|pdf)/)?(?:arxiv\s*:\s*)?", "")
    return F.nullif(F.regexp_replace(x, r"(?:v\d+)?(?:\.pdf)?\s*$", ""), F.lit(""))


def engine(name: str | Column) -> Column:
    """The number of the engine in :data:`ENGINES`."""
    x = F.lower(F.trim(F.col(name) if isinstance(name, str) else name))
    at = F.array_position(F.array(*map(F.lit, ENGINES[:-1])), F.coalesce(x, F.lit("")))
    return F.when(at > 0, at - 1).otherwise(len(ENGINES) - 1).cast("int")


def rank(level: str = "retrieved_level") -> Column:
    """A struct by which the better row is the greater."""
    score = F.col("candidate.score")
    valid = F.when(~F.isnan(score) & score.between(0, 1), score).otherwise(-1.0)
    present = sum((F.col(f"candidate.{f}").isNotNull().cast("int") for f in FIELDS), F.lit(0))
    return F.struct(
        F.coalesce(level, F.lit(-(2**31))).alias("level"),
        F.coalesce(valid, F.lit(-1.0)).alias("score"),
        present.alias("present"),
        F.greatest(F.lit(2) - engine("candidate.from_structure"), F.lit(0)).alias("engine"),
        F.col("retrieved_at").alias("at"),
        (-F.col("graded_id")).alias("minus_id"),
    )


def norm(value: Column) -> Column:
    """What spellings of one value have in common, its letters and digits parted by single blanks; null without any."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}]+", " ")), F.lit(""))


def _claim(rows: Column, field: str) -> Column:
    """The value of most votes in an array of rows; ties go to the latest, then to the greater."""
    votes = F.transform(rows, lambda x: F.struct(norm(x[field]).alias("norm"), x["at"].alias("at"), x[field].alias("value")))
    votes = F.filter(votes, lambda v: v["norm"].isNotNull())

    def total(v: Column, of: Column) -> Column:
        same = F.filter(of, lambda w: w["norm"] == v["norm"])
        at, value = F.array_max(F.transform(same, lambda w: w["at"])), F.array_max(F.transform(same, lambda w: w["value"]))
        return F.struct(F.size(same).alias("n"), at.alias("at"), v["norm"].alias("norm"), value.alias("value"))

    return F.get(F.transform(F.array(votes), lambda of: F.array_max(F.transform(of, lambda v: total(v, of)))), F.lit(0))["value"]


def _hot_claims(rows: DataFrame) -> DataFrame:
    """Claims of engines with many rows in a group: the same rule, by aggregations that combine map-side."""
    each = rows.select(*KEY, "engine", F.col("r.at").alias("at"), F.explode(F.array(*(
        F.struct(F.lit(f).alias("field"), norm(F.col(f)).alias("norm"), F.col(f).alias("value")) for f in FIELDS
    ))).alias("c")).select(*KEY, "engine", "at", "c.*").where("norm is not null")
    votes = each.groupBy(*KEY, "engine", "field", "norm").agg(F.count("*").alias("n"), F.max("at").alias("at"), F.max("value").alias("value"))
    most = votes.groupBy(*KEY, "engine", "field").agg(F.max(F.struct("n", "at", "norm", "value"))["value"].alias("value"))
    wide = most.groupBy(*KEY, "engine").agg(*(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in FIELDS))
    return rows.groupBy(*KEY, "engine").agg(F.max("r").alias("r"), F.count("*").alias("n")).join(wide, [*KEY, "engine"], "left")


def groups(graded: DataFrame) -> DataFrame:
    """One row per group: paper_key, pos, graded_id of the row ranked first, n_rows, claims.

    ``claims`` has for each field an array with the claim of each engine, null where it makes none.
    Rows of one hot group never meet in one task.
    """
    fields = [F.nullif(F.trim(F.col(f"candidate.{f}").cast("string")), F.lit("")).alias(f) for f in FIELDS]
    rows = graded.select(
        paper_key("paper_id").alias("paper_key"), "pos", engine("candidate.from_structure").alias("engine"), rank().alias("r"), *fields
    ).where("paper_key is not null and pos is not null")
    own = [*KEY, "engine"]
    hot = F.broadcast(rows.groupBy(*own).count().where(F.col("count") >= HOT_ROWS).select(*own))
    few = rows.join(hot, own, "left_anti").groupBy(*own).agg(
        F.max("r").alias("r"), F.count("*").alias("n"), F.collect_list(F.struct(F.col("r.at").alias("at"), *FIELDS)).alias("all")
    )
    claimed = few.select(*own, "r", "n", *(_claim(F.col("all"), f).alias(f) for f in FIELDS))
    held = claimed.unionByName(_hot_claims(rows.join(hot, own, "left_semi"))).groupBy(*KEY).agg(
        F.max("r").alias("best"), F.sum("n").alias("n_rows"),
        *(F.max(F.when(F.col("engine") == i, F.struct(*FIELDS))).alias(f"e{i}") for i in range(len(ENGINES))),
    )
    by_field = (F.array(*(F.col(f"e{i}")[f] for i in range(len(ENGINES)))).alias(f) for f in FIELDS)
    return held.select(*KEY, (-F.col("best.minus_id")).alias("graded_id"), "n_rows", F.struct(*by_field).alias("claims"))


def pattern(values: Column) -> Column:
    """How the claims of a field agree: a sign per engine, the first engine with the same value, or - for none."""
    normed = F.transform(values, norm)

    def signs(n: Column) -> Column:
        at = F.transform(n, lambda v: F.coalesce(F.array_position(n, v) - 1, F.lit(-1)))
        return F.array_join(F.transform(at, lambda i: F.when(i < 0, F.lit("-")).otherwise(i.cast("string"))), "")

    return F.get(F.transform(F.array(normed), signs), F.lit(0))


def pattern_counts(held: DataFrame) -> dict[str, int]:
    """Number of items of each pattern; at most 52 of them for four engines."""
    each = held.select(F.explode(F.array(*(pattern(F.col(f"claims.{f}")) for f in FIELDS))).alias("pattern"))
    counts = each.groupBy("pattern").count().collect()
    return {r["pattern"]: r["count"] for r in counts if set(r["pattern"]) != {"-"}}


#: Weight, in items, of the prior belief that an engine copies a twentieth of another's claims, and that share.
PRIOR_ITEMS, PRIOR_COPIES = 20.0, 0.05
#: Claims that an engine may at most take from others.
MOST_COPIED = 0.95


def _step(patterns: dict[str, int], accuracy: list[float], copies: dict[tuple[int, int], float], false_values: int) -> tuple:
    """One round of expectation-maximisation: accuracies, copied shares, log-likelihood, and the posterior of each pattern's values.

    An engine takes its claim from an earlier one with the chance ``copies``; else it says the truth with
    its accuracy, or one of the false values. The truth may be a value that nobody claims.
    """
    k = len(accuracy)
    right, asked = [1.0] * k, [1.25] * k
    taken, both = dict.fromkeys(copies, PRIOR_ITEMS * PRIOR_COPIES), dict.fromkeys(copies, PRIOR_ITEMS)
    total, posts = 0.0, {}
    for pattern, count in patterns.items():
        claims = {i: int(v) for i, v in enumerate(pattern) if v != "-"}
        values: list[int | None] = [*sorted(set(claims.values())), None]
        told = []
        for v in values:
            like = (1 if v is not None else max(1, false_values + 2 - len(values))) / (false_values + 1)
            shares = []
            for i, c in claims.items():
                before = {j: copies[j, i] for j in claims if j < i}
                scale = min(1.0, MOST_COPIED / max(sum(before.values()), 1e-12))
                own = (1 - scale * sum(before.values())) * (accuracy[i] if c == v else (1 - accuracy[i]) / false_values)
                same = {j: scale * w for j, w in before.items() if claims[j] == c}
                chance = own + sum(same.values())
                like *= chance
                shares.append((i, c, own / chance, {j: w / chance for j, w in same.items()}, before))
            told.append((like, shares))
        z = sum(x for x, _ in told)
        total += count * log(z)
        posts[pattern] = {v: x / z for v, (x, _) in zip(values, told, strict=True)}
        for v, (x, shares) in zip(values, told, strict=True):
            for i, c, own, same, before in shares:
                right[i] += count * x / z * own * (c == v)
                asked[i] += count * x / z * own
                for j in before:
                    both[j, i] += count * x / z
                    taken[j, i] += count * x / z * same.get(j, 0.0)
    fitted = [min(0.99, max(0.05, r / a)) for r, a in zip(right, asked, strict=True)]
    return fitted, {p: taken[p] / both[p] for p in copies}, total, posts


def fit(patterns: dict[str, int], rounds: int = 60, false_values: int = 20) -> dict:
    """Accuracies, shares of copied claims and, for each pattern, the winning engine and its posterior.

    Who copies and who is right can be told in more ways than one, so the rounds begin once without
    copying and once for each pair of engines, and the likeliest outcome holds.
    """
    k = len(ENGINES)
    pairs = list(combinations(range(k), 2))
    best: tuple = ()
    for start in ({}, *({p: 0.8} for p in pairs)):
        accuracy, copies = [0.8] * k, {p: start.get(p, PRIOR_COPIES) for p in pairs}
        for _ in range(rounds):
            accuracy, copies, likely, posts = _step(patterns, accuracy, copies, false_values)
        if patterns and (not best or likely > best[2] + 1e-6):
            best = (accuracy, copies, likely, posts)
    if not best:
        best = ([0.8] * k, dict.fromkeys(pairs, PRIOR_COPIES), 0.0, {})
    chosen = {}
    for pattern, post in best[3].items():
        v = max((v for v in post if v is not None), key=lambda v: (post[v], -v))
        chosen[pattern] = (v, post[v])
    return {"accuracy": best[0], "depends": best[1], "chosen": chosen}


def fuse(graded: DataFrame) -> DataFrame:
    """One record per group: paper_key, pos, graded_id, n_rows, each field's best-supported value,
    and ``support``, the mean posterior probability of the fused values."""
    held = persist_table(groups(graded), "groups")
    chosen = fit(pattern_counts(held))["chosen"]
    pairs = [F.lit(x) for p, (e, q) in sorted(chosen.items()) for x in (p, f"{e} {q:.6f}")]
    verdicts = F.create_map(*pairs) if pairs else F.create_map(F.lit("-"), F.lit("0 0"))

    def decided(f: str) -> Column:
        verdict = F.split(F.element_at(verdicts, pattern(F.col(f"claims.{f}"))), " ")
        value = F.get(F.col(f"claims.{f}"), F.get(verdict, F.lit(0)).cast("int"))
        return F.struct(value.alias("value"), F.get(verdict, F.lit(1)).cast("double").alias("posterior"))

    made = held.select(*KEY, "graded_id", "n_rows", *(decided(f).alias(f) for f in FIELDS))
    known = F.array_compact(F.array(*(F.col(f"{f}.posterior") for f in FIELDS)))
    mean = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(known), F.lit(0))
    values = [F.col(f"{f}.value").alias(f) if f != "year" else F.col("year.value").try_cast("int").alias("year") for f in FIELDS]
    return made.select(*KEY, "graded_id", "n_rows", *values, mean.alias("support"))


def source_model(graded: DataFrame) -> DataFrame:
    """The fitted accuracy of each engine and, per pair, the share of the second one's claims that are copies of the first one's."""
    model = fit(pattern_counts(groups(graded)))
    rows = [(ENGINES[i], None, a) for i, a in enumerate(model["accuracy"])]
    rows += [(ENGINES[i], ENGINES[j], d) for (i, j), d in model["depends"].items()]
    return graded.sparkSession.createDataFrame(rows, "engine string, other string, value double")
