"""Token-set similarity: an Arrow UDF for bulk scoring, and the same formula as column expressions."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from siteweave.functions.geo import round_half_even


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits of Python integers."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


@lru_cache(1 << 13)
def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


def token_set_ratio(a: str | None, b: str | None) -> float:
    """0 to 100: how alike two texts are as sets of words; 0 if either is empty."""
    if not a or not b:
        return 0.0
    left, right = _words(a), _words(b)
    if not left or not right:
        return 0.0
    both = left & right
    only_a, only_b = " ".join(sorted(left - both)), " ".join(sorted(right - both))
    if both and (not only_a or not only_b):
        return 100.0
    s, la, lb = len(" ".join(sorted(both))), len(only_a), len(only_b)
    k = 1 if s else 0
    apart = la + lb - 2 * common_subsequence(only_a, only_b)
    best = 100.0 - 100.0 * apart / ((s + k + la) + (s + k + lb))
    if s:
        best = max(best, 100.0 - 100.0 * (k + la) / (s + s + k + la), 100.0 - 100.0 * (k + lb) / (s + s + k + lb))
    return best


#: Pairs of texts that a task remembers for each score.
REMEMBERED = 5_000


def token_set(a: Column, b: Column) -> Column:
    """``token_set_ratio`` of two columns; pairs that were scored are remembered, up to ``REMEMBERED`` of them and a batch.

    It is called nondeterministic so that a filter on the score stays above it, instead of scoring each pair a second time below.
    """

    @F.pandas_udf("double")
    def scored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: dict[tuple, float] = {}
        for left, right in batches:
            if len(known) > REMEMBERED:
                known.clear()
            out = []
            for pair in zip(left, right, strict=True):
                if pair not in known:
                    known[pair] = token_set_ratio(*pair)
                out.append(known[pair])
            yield pd.Series(out, index=left.index, dtype="float64")

    return scored.asNondeterministic()(a, b)


def token_set_native(a: Column, b: Column) -> Column:
    """The same by expressions of the engine alone; some ten times slower."""
    left, right = (F.array_distinct(F.filter(F.split(F.coalesce(x, F.lit("")), " "), lambda t: t != "")) for x in (a, b))
    both = F.array_intersect(left, right)
    only_a, only_b = (F.array_join(F.array_sort(F.array_except(x, both)), " ") for x in (left, right))
    s, la, lb = F.length(F.array_join(both, " ")), F.length(only_a), F.length(only_b)
    k = F.when(s > 0, 1).otherwise(0)
    places = F.filter(F.split(only_b, ""), lambda c: c != "")

    def row(above: Column, c: Column) -> Column:
        return F.aggregate(
            F.arrays_zip(places.alias("c"), F.slice(above, 1, lb).alias("d"), F.slice(above, 2, lb).alias("u")),
            F.array(F.lit(0)),
            lambda acc, x: F.concat(acc, F.array(F.when(x["c"] == c, x["d"] + 1).otherwise(F.greatest(x["u"], F.element_at(acc, -1))))),
        )

    lcs = F.element_at(F.aggregate(F.filter(F.split(only_a, ""), lambda c: c != ""), F.array_repeat(F.lit(0), lb + 1), row), -1)
    first = 100.0 - 100.0 * (la + lb - 2 * F.when((la > 0) & (lb > 0), lcs).otherwise(0)) / ((s + k + la) + (s + k + lb))
    sides = [100.0 - 100.0 * (k + x) / (s + s + k + x) for x in (la, lb)]
    return (
        F.when((F.size(left) == 0) | (F.size(right) == 0), 0.0)
        .when((F.size(both) > 0) & ((la == 0) | (lb == 0)), 100.0)
        .when(s == 0, first)
        .otherwise(F.greatest(first, *sides))
    )


#: The texts that are compared, of either side, in this order; the owner is compared with the company.
TEXTS = {"address": ("core", "core"), "owner": ("company_norm", "facility_owner_norm"), "company": ("company_norm", "company_norm"), "name": ("facility_name_norm", "facility_name_norm"), "city": ("city_norm", "city_norm")}


def text_scores(a: str, b: str) -> Column:
    """The token-set ratios of ``TEXTS`` for records held as structs ``a`` and ``b``, as one struct; ratios are remembered as in ``token_set``.

    One function for all five, as each of its own is one more Python worker in every task; nondeterministic as there.
    """

    @F.pandas_udf(", ".join(f"{name} double" for name in TEXTS))
    def scored(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        known: dict[tuple, float] = {}
        for columns in batches:
            if len(known) > len(TEXTS) * REMEMBERED:
                known.clear()
            out = {}
            for k, name in enumerate(TEXTS):
                ratios = []
                for pair in zip(columns[2 * k], columns[2 * k + 1], strict=True):
                    if pair not in known:
                        known[pair] = token_set_ratio(*pair)
                    ratios.append(known[pair])
                out[name] = ratios
            yield pd.DataFrame(out, dtype="float64")

    owner, company = F.col(f"{b}.facility_owner_norm"), F.col(f"{b}.company_norm")
    # an owner that is the company scores as the company does, and the better of both counts
    texts = {"owner": (F.col(f"{a}.company_norm"), F.when(~owner.eqNullSafe(company), owner))}
    sides = [x for name, (left, right) in TEXTS.items() for x in texts.get(name, (F.col(f"{a}.{left}"), F.col(f"{b}.{right}")))]
    return scored.asNondeterministic()(*sides)


def with_scores(pairs, rules):  # noqa: ANN001, ANN201
    """``pairs`` (structs a and b) with the seven scores, rounded to two decimals after they are combined."""
    ratio = {name: F.col(f"__ratio.{name}") for name in TEXTS}
    number_a, number_b = F.col("a.number"), F.col("b.number")
    other = (number_a != "") & (number_b != "") & (number_a != number_b)
    parts = {
        "__capped": F.when(other, F.least(ratio["address"], F.lit(rules.other_number))).otherwise(ratio["address"]), "__best": F.greatest(ratio["owner"], ratio["company"]),
        "state_match": (F.col("a.state_norm") != "") & (F.col("a.state_norm") == F.col("b.state_norm")), "postal_match": (F.col("a.postal_code_norm") != "") & (F.col("a.postal_code_norm") == F.col("b.postal_code_norm")),
    }
    scored = pairs.withColumn("__ratio", text_scores("a", "b")).withColumns(parts)
    combined = F.col("__capped") * rules.address + F.col("__best") * rules.company + ratio["name"] * rules.name + ratio["city"] * rules.city
    combined = combined + F.when(F.col("state_match"), rules.same_state).otherwise(0.0) + F.when(F.col("postal_match"), rules.same_postal).otherwise(0.0)
    named = {"address_score": F.col("__capped"), "company_score": F.col("__best"), "facility_name_score": ratio["name"], "city_score": ratio["city"]}
    scored = scored.withColumns({k: round_half_even(v, 2) for k, v in named.items()} | {"combined_score": round_half_even(F.least(combined, F.lit(100.0)), 2)})
    return scored.drop("__ratio", "__capped", "__best")
