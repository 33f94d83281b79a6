"""The whole linkage: two raw tables to nine result tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.config import COUNTRY, RULES, Rules
from siteweave.functions.geo import CellFunction, hex_cell
from siteweave.functions.similarity import with_scores  # noqa: F401
from siteweave.operators import assign, blocking, tiles
from siteweave.operators.cluster import fuzzy_dedupe
from siteweave.operators.consolidate import primary_dedupe
from siteweave.operators.normalize import canonical_a, canonical_b, with_norms
from siteweave.recovery import cut, settled, spread

SHOWN = ["company_raw", "facility_owner_raw", "facility_name_raw", "street_address_raw", "city_raw", "state_raw", "postal_code_raw", "latitude", "longitude"]
SCORES = ["combined_score", "address_score", "company_score", "facility_name_score", "city_score", "state_match", "postal_match"]

#: Pairs that the review pass scores in one level.
LEVEL = 3_000_000


def normalized(raw: DataFrame, source: str) -> DataFrame:
    """Normalized records of one source in the country of the linkage.

    Raw rows are dealt out first: a small file is one partition, and cleansing it costs far more than reading it.
    """
    return with_norms((canonical_a if source == "A" else canonical_b)(spread(raw, "source_row"))).where(F.col("country_standard") == COUNTRY)


def deduped(records: DataFrame, source: str, cell: CellFunction = hex_cell) -> DataFrame:
    """Logical records: consolidated by ids, then by coordinates and addresses."""
    return fuzzy_dedupe(settled(cut(primary_dedupe(records, source, cell))), cell)


def unmatched(records: DataFrame, matches: DataFrame, side: str) -> DataFrame:
    return records.join(matches.select(F.col(f"{side}_ord").alias("ord")), "ord", "left_anti")


def cell_pass(a: DataFrame, b: DataFrame, level: str, rules: Rules = RULES, predicate: Callable[[tuple], Column] = assign.pass_predicate) -> DataFrame:
    """Matches (a_ord, b_ord, cell, scores, match_stage, match_reason) of one cell pass.

    ``predicate`` makes the condition of an eligible pair, over the score columns, from the thresholds of the level.
    """
    ways = rules.fine if level == "fine" else rules.coarse
    sides = [df.withColumn("cell", F.explode(F.array_distinct(f"cells_{level}"))) for df in (a, b)]
    rows, _ = tiles.dealt([("cell", *sides, ["cell"])], blocking.SCORED)
    # nothing is known of another condition, so all pairs are scored for it
    found = tiles.scored(rows, rules, tiles.Wanted(ways=ways if predicate is assign.pass_predicate else None)).where(predicate(ways))
    eligible = found.groupBy("a_ord", "b_ord").agg(F.min(F.struct("cell", *SCORES)).alias("p")).select("a_ord", "b_ord", "p.*")
    stage = f"{level} cell"
    return assign.greedy(eligible, assign.by_scores).withColumns({"match_stage": F.lit(stage), "match_reason": assign.match_reason(stage), "manual_label": F.lit(None).cast("string")})


def review_pass(a: DataFrame, b: DataFrame, rules: Rules = RULES, at_once: int = LEVEL) -> DataFrame:
    """Matches of the relaxed pass, with their labels. What gets no label takes nobody's place.

    Greedy takes the pairs level by level: those above a combined score, then those above a lower one between records that are
    still free. Levels come from a count of what all pairs score at most, so each has about ``LEVEL`` pairs to score.
    """
    wanted = {"floor": rules.review_floor}
    few, first = blocking.state_sides(a, b, rules)
    free, fallback, found = (a, b), (cut(few), cut(first)), None
    while True:
        rows, pairs = tiles.dealt(blocking.review_blocks(*free, *fallback), blocking.SCORED)
        least = tiles.level(tiles.histogram(rows, rules, tiles.Wanted(**wanted)), at_once) if pairs > at_once else None
        edges = tiles.scored(rows, rules, tiles.Wanted(**wanted, least=least)).drop("cell").where(assign.review_floor(rules))
        held = settled(cut(assign.greedy(edges.withColumn("manual_label", assign.review_label()).where("manual_label IS NOT NULL"), assign.by_combined)))
        found = held if found is None else found.unionByName(held)
        if least is None:
            break
        free, fallback = ([cut(unmatched(x, held, s)) for x, s in zip(sides, "ab", strict=True)] for sides in (free, fallback))
    return found.withColumns({"cell": F.lit(""), "match_stage": F.lit("manual review"), "match_reason": F.lit("manual review")})


def with_display(matches: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Matches with what both records show."""
    own = lambda df, s, more: df.select(F.col("ord").alias(f"{s}_ord"), F.col("logical_record_id").alias(f"{s}_logical_id"), F.col("source_primary_ids").alias(f"{s}_source_ids"), *more, *[F.col(c).alias(f"{s}_{c}") for c in SHOWN])
    held = matches.join(own(a, "a", []), "a_ord").join(own(b, "b", [F.col("campus_ids").alias("b_campus_ids")]), "b_ord")
    first = ["match_stage", "match_reason", "manual_label", "a_logical_id", "a_source_ids", "b_logical_id", "b_source_ids", "b_campus_ids", "cell", *SCORES]
    return held.select(*first, *[f"{s}_{c}" for c in SHOWN for s in "ab"])


def review_table(matches: DataFrame, a: DataFrame, b: DataFrame, left_a: DataFrame, left_b: DataFrame) -> DataFrame:
    """Each match of the relaxed pass once for either source, then what is left of both."""
    shown = with_display(matches, a, b)
    twice = [shown.select(F.lit(s.upper()).alias("review_source"), F.col("manual_label").alias("review_label"), "*") for s in "ab"]
    rest = []
    for s, left in (("a", left_a), ("b", left_b)):
        named = {f"{s}_logical_id": "logical_record_id", f"{s}_source_ids": "source_primary_ids"} | {f"{s}_{c}": c for c in SHOWN} | ({"b_campus_ids": "campus_ids"} if s == "b" else {})
        rest.append(left.select(F.lit(s.upper()).alias("review_source"), F.lit("Definitely unique").alias("review_label"), F.lit("Definitely unique").alias("manual_label"), *[F.col(c).alias(n) for n, c in named.items()]))
    out = twice[0]
    for more in (twice[1], *rest):
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def counted(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of each table, under its name."""
    rows = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, rows).agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in tables])


def funnel_row(stage: str, a: str, b: str, matched: list[str], last: tuple[str, str] | None = None) -> Column:
    """One row of the summary, as a struct of the names of counts."""
    total = reduce(add, [F.col(m) for m in matched], F.lit(0)).cast("long")
    left = [F.col(c) for c in last] if last else [F.greatest(F.col(c) - total, F.lit(0)) for c in (a, b)]
    values = {"stage": F.lit(stage), "a_records": F.col(a), "b_records": F.col(b), "matched": total, "unique_a": left[0], "unique_b": left[1], "still_unmatched": (F.lit(0) if last else left[0] + left[1]).cast("long")}
    return F.struct(*[v.alias(k) for k, v in values.items()])


class Linkage:
    """The results of a cascade. Each pass is made when it is first asked for, and kept behind a checkpoint."""

    def __init__(self, a_us: DataFrame, b_us: DataFrame, a: DataFrame, b: DataFrame, rules: Rules, predicate: Callable[[tuple], Column]) -> None:
        self.a_us, self.b_us, self.a, self.b, self.rules, self.predicate = a_us, b_us, a, b, rules, predicate

    @cached_property
    def fine(self) -> DataFrame:
        return settled(cut(cell_pass(self.a, self.b, "fine", self.rules, self.predicate)))

    @cached_property
    def _after_fine(self) -> tuple[DataFrame, DataFrame]:
        return unmatched(self.a, self.fine, "a"), unmatched(self.b, self.fine, "b")

    @cached_property
    def coarse(self) -> DataFrame:
        return settled(cut(cell_pass(*self._after_fine, "coarse", self.rules, self.predicate)))

    @cached_property
    def _after_coarse(self) -> tuple[DataFrame, DataFrame]:
        a, b = self._after_fine
        return cut(unmatched(a, self.coarse, "a")), cut(unmatched(b, self.coarse, "b"))

    @cached_property
    def manual(self) -> DataFrame:
        return settled(cut(review_pass(*self._after_coarse, self.rules)))

    @property
    def left_a(self) -> DataFrame:
        return unmatched(self._after_coarse[0], self.manual, "a")

    @property
    def left_b(self) -> DataFrame:
        return unmatched(self._after_coarse[1], self.manual, "b")

    def matches(self) -> DataFrame:
        found = self.fine.unionByName(self.coarse).unionByName(self.manual)
        return with_display(found, self.a, self.b)

    def review(self) -> DataFrame:
        return review_table(self.manual, self.a, self.b, self.left_a, self.left_b)

    def summary(self) -> DataFrame:
        found = {"fine": self.fine, "coarse": self.coarse, "manual": self.manual}
        counts = counted({"a_us": self.a_us, "b_us": self.b_us, "a": self.a, "b": self.b} | found | {"left_a": self.left_a, "left_b": self.left_b})
        rows = [
            funnel_row("1. after US filtering", "a_us", "b_us", []),
            funnel_row("2. after within-source deduplication", "a", "b", []),
            funnel_row("3. after fine-cell matching", "a", "b", ["fine"]),
            funnel_row("4. after coarse-cell matching", "a", "b", ["fine", "coarse"]),
            funnel_row("5. after manual review", "a", "b", [*found], ("left_a", "left_b")),
        ]
        return counts.select(F.explode(F.array(*rows)).alias("row")).select("row.*")

    def tabs(self) -> dict[str, DataFrame]:
        """The nine tabs: normalized rows as in their source, logical records by ordinal, matches by stage and score."""
        own = lambda df: df.orderBy("ord").drop("core", "number")
        stage = F.array_position(F.array(*map(F.lit, ("fine cell", "coarse cell", "manual review"))), F.col("match_stage"))
        best = [stage, F.desc("combined_score"), F.desc("address_score"), "a_logical_id", "b_logical_id"]
        unique = (F.col("review_label") == "Definitely unique").cast("int")
        return {
            "summary": self.summary().orderBy("stage"), "a_normalized": self.a_us.orderBy("source_row"), "b_normalized": self.b_us.orderBy("source_row"),
            "a_deduped": own(self.a), "b_deduped": own(self.b), "match_pairs": self.matches().orderBy(*best),
            "manual_review": self.review().orderBy(unique, F.desc("combined_score"), "a_logical_id", "b_logical_id", "review_source"),
            "unmatched_a": own(self.left_a), "unmatched_b": own(self.left_b),
        }


def link(
    a_us: DataFrame,
    b_us: DataFrame,
    rules: Rules = RULES,
    logical: tuple[DataFrame, DataFrame] | None = None,
    cell: CellFunction = hex_cell,
    predicate: Callable[[tuple], Column] = assign.pass_predicate,
) -> Linkage:
    """The cascade over normalized records; ``logical`` may bring logical records that are there already.

    ``cell`` and ``predicate`` replace the grid and the condition of the cell passes.
    """
    a, b = (settled(cut(blocking.with_core(x))) for x in (logical or (deduped(a_us, "A", cell), deduped(b_us, "B", cell))))
    return Linkage(a_us, b_us, a, b, rules, predicate)
