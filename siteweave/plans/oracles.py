"""The linkage in SQL for DuckDB, step by step, as what the queries are held against."""

from __future__ import annotations

from siteweave import config
from siteweave.functions.geo import EDGE_KM, KM_PER_DEGREE
from siteweave.functions.text import state_patterns
from siteweave.sources.tables import SITES_SQL


def quoted(values) -> str:  # noqa: ANN001
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def case(table: dict[str, str], key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE {key} END"


def fold(x: str) -> str:
    return rf"regexp_replace(strip_accents(trim(coalesce(CAST({x} AS VARCHAR), ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '[^\x00-\x7F]', '', 'g')"


def compact(x: str) -> str:
    return f"trim(regexp_replace(replace(lower({fold(x)}), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def without(x: str, gone) -> str:  # noqa: ANN001
    return f"array_to_string(list_filter({words(compact(x))}, lambda t: t NOT IN ({quoted(gone)})), ' ')"


def company(x: str) -> str:
    return without(x, config.COMPANY_WORDS)


def address(x: str) -> str:
    return f"array_to_string(list_transform({words(compact(x))}, lambda t: {case(config.STREET_WORDS, 't')}), ' ')"


def state(x: str) -> str:
    return case(config.STATES, compact(x))


def country(x: str) -> str:
    return f"CASE WHEN {without(x, ('the',))} IN ({quoted(config.COUNTRY_ALIASES)}) THEN '{config.COUNTRY}' ELSE {fold(x)} END"


def postal(x: str) -> str:
    return f"regexp_extract({fold(x)}, '{config.POSTAL}')"


def state_in_address(x: str) -> str:
    before, comma, name = state_patterns()
    named = f"nullif(regexp_extract({compact(x)}, '{name}', 1), '')"
    return f"coalesce(nullif(lower(regexp_extract({fold(x)}, '{before}', 1)), ''), nullif(lower(regexp_extract({fold(x)}, '{comma}', 1)), ''), {case(config.STATES, named)}, '')"


def half_even(x: str, digits: int) -> str:
    return f"round_even(({x}) * {float(10**digits)!r}::DOUBLE, 0) / {float(10**digits)!r}::DOUBLE"


def trunc3(x: str) -> str:
    return f"trunc({x} * 1000) / 1000"


def cell(level: str, lat: str = "latitude", lon: str = "longitude") -> str:
    """The hexagon, by the same arithmetic."""
    edge = repr(EDGE_KM[level]) + "::DOUBLE"
    band = f"floor({trunc3(lat)})"
    x = f"({trunc3(lon)} * cos(radians({band} + 0.5::DOUBLE)) * {KM_PER_DEGREE!r}::DOUBLE)"
    y = f"({trunc3(lat)} * {KM_PER_DEGREE!r}::DOUBLE)"
    q, r = f"(({x} * 0.5773502691896257::DOUBLE - {y} / 3.0::DOUBLE) / {edge})", f"({y} * {2.0 / 3.0!r}::DOUBLE / {edge})"
    s = f"(-{q} - {r})"
    rq, rr, rs = (f"round_even({v}, 0)" for v in (q, r, s))
    dq, dr, ds = f"abs({rq} - {q})", f"abs({rr} - {r})", f"abs({rs} - {s})"
    cq = f"CASE WHEN {dq} > {dr} AND {dq} > {ds} THEN -{rr} - {rs} ELSE {rq} END"
    cr = f"CASE WHEN {dq} > {dr} AND {dq} > {ds} THEN {rr} WHEN {dr} > {ds} THEN -{rq} - {rs} ELSE {rr} END"
    return f"CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL THEN concat_ws(':', '{level[0]}', CAST({band} AS BIGINT), CAST({cq} AS BIGINT), CAST({cr} AS BIGINT)) END"


def token_set(name: str, pairs: str) -> str:
    """CTEs that end in ``name`` (a, b, score) for the different pairs of ``pairs`` (a, b)."""
    lcs = """list_reduce(list_prepend(list_transform(range(0, length(db) + 1), lambda x: 0), list_transform(range(1, length(da) + 1), lambda k: [ord(substring(da, k, 1))])),
      lambda r, ca: list_reduce(list_prepend([0], list_transform(range(1, length(db) + 1), lambda j: [j::int])),
        lambda acc, j: list_append(acc, CASE WHEN chr(ca[1]) = substring(db, j[1], 1) THEN r[j[1]] + 1 ELSE greatest(r[j[1] + 1], acc[j[1]]) END)))[-1]"""
    return f"""{name}_0 AS MATERIALIZED (SELECT DISTINCT a, b FROM ({pairs}) p),
{name}_1 AS (SELECT a, b, list_distinct({words('a')}) AS wa, list_distinct({words('b')}) AS wb FROM {name}_0),
{name}_2 AS (SELECT a, b, wa, wb, list_filter(wa, lambda t: list_contains(wb, t)) AS both_w, array_to_string(list_sort(list_filter(wa, lambda t: NOT list_contains(wb, t))), ' ') AS da,
  array_to_string(list_sort(list_filter(wb, lambda t: NOT list_contains(wa, t))), ' ') AS db FROM {name}_1),
{name}_3 AS (SELECT *, length(array_to_string(both_w, ' ')) AS s, CASE WHEN len(both_w) > 0 THEN 1 ELSE 0 END AS k, length(da) AS la, length(db) AS lb,
  CASE WHEN length(da) > 0 AND length(db) > 0 THEN {lcs} ELSE 0 END AS common FROM {name}_2),
{name}_4 AS (SELECT *, 100.0::DOUBLE - 100.0::DOUBLE * (la + lb - 2 * common) / ((s + k + la) + (s + k + lb)) AS r1 FROM {name}_3),
{name} AS MATERIALIZED (SELECT a, b, CASE WHEN len(wa) = 0 OR len(wb) = 0 THEN 0.0::DOUBLE WHEN k = 1 AND (la = 0 OR lb = 0) THEN 100.0::DOUBLE WHEN s = 0 THEN r1
  ELSE greatest(r1, 100.0::DOUBLE - 100.0::DOUBLE * (k + la) / (s + s + k + la), 100.0::DOUBLE - 100.0::DOUBLE * (k + lb) / (s + s + k + lb)) END AS score FROM {name}_4)"""


def ordered(x: str, order: str = "ord") -> str:
    """The non-empty values in order."""
    return f"coalesce(list({fold(x)} ORDER BY {order}) FILTER ({fold(x)} <> ''), [])"


def distinct(values: str) -> str:
    return f"list_filter({values}, lambda x, i: list_position({values}, x) = i)"


def mode(values: str) -> str:
    found = f"list_transform({distinct(values)}, lambda x: {{'n': len(list_filter({values}, lambda y: y = x)), 'p': -list_position({values}, x), 'v': x}})"
    return f"coalesce(list_reverse_sort({found})[1].v, '')"


def joined(values: str, limit: int | None = None) -> str:
    if limit is None:
        return f"array_to_string({values}, ' | ')"
    return f"array_to_string(CASE WHEN len({values}) > {limit} THEN list_append({values}[1:{limit}], '... (' || CAST(len({values}) - {limit} AS VARCHAR) || ' more)') ELSE {values} END, ' | ')"


LISTS = {
    "source_primary_ids": ("source_primary_id", None), "company_raw": ("company_raw", 8), "facility_owner_raw": ("facility_owner_raw", 8),
    "facility_name_raw": ("facility_name_raw", 8), "member_source_rows": ("source_row", None),
}
MODES = ["street_address_raw", "city_raw", "state_raw", "postal_code_raw", "country_raw"]


def norms() -> str:
    return f"""{company('company_raw')} AS company_norm, {company('facility_owner_raw')} AS facility_owner_norm, {compact('facility_name_raw')} AS facility_name_norm,
  {address('street_address_raw')} AS street_address_norm, {compact('city_raw')} AS city_norm, {state('state_raw')} AS state_norm,
  coalesce(nullif({compact('postal_code_raw')}, ''), {compact(postal('street_address_raw'))}) AS postal_code_norm,
  {half_even('latitude', 4)} AS lat_round_4, {half_even('longitude', 4)} AS lon_round_4"""


def consolidate(name: str, source: str, key: str) -> str:
    """CTEs that end in ``name``: ``source`` consolidated by ``key`` within each site source."""
    fields = sorted({*(f for f, _ in LISTS.values()), *MODES, "cell_fine", "cell_coarse"})
    mean = lambda c: half_even(f"CAST(avg(CAST({c} AS DECIMAL(28, 12))) AS DOUBLE)", 8)
    lists = ", ".join(f"{joined(f'd_{f}', limit)} AS {n}" for n, (f, limit) in LISTS.items())
    modes = ", ".join(f"{mode(f'l_{f}')} AS {f}" for f in MODES if f != "postal_code_raw")
    return f"""{name}_1 AS MATERIALIZED (SELECT source, {key} AS logical_record_id, min(ord) AS ord, count(*) AS member_count, arg_min(dedupe_reason, ord) AS dedupe_reason,
  {mean('latitude')} AS latitude, {mean('longitude')} AS longitude, {', '.join(f"{ordered(f)} AS l_{f}" for f in fields)} FROM {source} GROUP BY source, {key}),
{name}_2 AS MATERIALIZED (SELECT *, {', '.join(f"{distinct(f'l_{f}')} AS d_{f}" for f in fields)} FROM {name}_1),
{name}_3 AS MATERIALIZED (SELECT source, logical_record_id, ord, member_count, dedupe_reason, latitude, longitude, d_cell_fine AS cells_fine, d_cell_coarse AS cells_coarse,
  {lists}, {modes}, {mode('l_postal_code_raw')} AS postal_0 FROM {name}_2),
{name}_4 AS (SELECT * EXCLUDE (postal_0), coalesce(nullif(postal_0, ''), {postal('street_address_raw')}) AS postal_code_raw FROM {name}_3),
{name} AS MATERIALIZED (SELECT *, {norms()} FROM {name}_4)"""


def core() -> str:
    units = f"list_transform({words('street_address_norm')}, lambda t: t IN ({quoted(config.UNIT_WORDS)}))"
    first = f"coalesce(list_position({units}, true), 0)"
    before = f"CASE WHEN {first} > 0 THEN {words('street_address_norm')}[1:{first} - 1] ELSE {words('street_address_norm')} END"
    names = case({code: name for name, code in config.STATES.items()}, "state_norm")
    names = f"CASE WHEN state_norm IN ({quoted(config.STATES.values())}) THEN {names} ELSE '' END"
    gone = f"list_concat(list_concat({words('city_norm')}, [state_norm, postal_code_norm]), list_concat({words(names)}, [{quoted(config.COUNTRY_WORDS)}]))"
    return f"array_to_string(list_filter({before}, lambda t: NOT list_contains({gone}, t)), ' ')"


def number(x: str = "core") -> str:
    return f"coalesce(list_filter({words(x)}, lambda t: regexp_matches(t, '^[0-9]+$'))[1], '')"


def normalized() -> str:
    own = "CASE WHEN source = 'A' THEN {a} ELSE {b} END"
    return f"""sites AS MATERIALIZED ({SITES_SQL}),
raw AS (SELECT source, CAST(source_row AS BIGINT) AS source_row, rec_id AS source_primary_id, company_raw, company_raw AS facility_owner_raw, facility_name_raw, street_address_raw, city_raw,
  {own.format(a=state_in_address('street_address_raw'), b='state_raw')} AS state_raw, {own.format(a=postal('street_address_raw'), b='postal_code_raw')} AS postal_code_raw,
  country_raw, latitude, longitude, campus_id, campus_name, part_of_campus FROM sites),
norm AS MATERIALIZED (SELECT *, {country('country_raw')} AS country_standard, {norms()}, {cell('fine')} AS cell_fine, {cell('coarse')} AS cell_coarse FROM raw),
us AS MATERIALIZED (SELECT *, source_row AS ord, CASE WHEN source = 'A' THEN 'site:' || source_primary_id WHEN {compact('part_of_campus')} = 'yes' AND {fold('campus_id')} <> '' THEN 'campus:' || campus_id
    WHEN {compact('part_of_campus')} = 'yes' AND {compact('campus_name')} <> '' THEN concat_ws(':', 'campus_name', {compact('campus_name')}, city_norm, state_norm) ELSE 'dcid:' || source_primary_id END AS key,
  CASE WHEN source = 'A' THEN '{config.REASON['A']}' ELSE '{config.REASON['B']}' END AS dedupe_reason FROM norm WHERE country_standard = '{config.COUNTRY}')"""


def clusters() -> str:
    pairs = "SELECT p.street_address_norm AS a, q.street_address_norm AS b FROM prim p JOIN prim q ON p.source = q.source AND p.lat_round_4 = q.lat_round_4 AND p.lon_round_4 = q.lon_round_4 AND p.ord < q.ord"
    return f"""{token_set('alike', pairs)},
links AS MATERIALIZED (SELECT p.source, p.ord AS a, q.ord AS b FROM prim p JOIN prim q ON p.source = q.source AND p.lat_round_4 = q.lat_round_4 AND p.lon_round_4 = q.lon_round_4 AND p.ord < q.ord
  JOIN alike t ON t.a = p.street_address_norm AND t.b = q.street_address_norm WHERE t.score >= 90),
both_ways AS (SELECT source, a, b FROM links UNION ALL SELECT source, b, a FROM links),
reach AS (SELECT source, ord AS a, ord AS b FROM prim UNION SELECT r.source, r.a, l.b FROM reach r JOIN both_ways l ON l.source = r.source AND l.a = r.b),
cluster AS MATERIALIZED (SELECT source, a AS ord, min(b) AS cluster_ord FROM reach GROUP BY source, a),
again AS MATERIALIZED (SELECT p.source, p.ord, CAST(c.cluster_ord AS VARCHAR) AS key, p.member_source_rows AS source_row, p.source_primary_ids AS source_primary_id, p.company_raw, p.facility_owner_raw,
  p.facility_name_raw, p.street_address_raw, p.city_raw, p.state_raw, p.postal_code_raw, p.country_raw, p.latitude, p.longitude, p.dedupe_reason,
  {cell('fine', 'p.latitude', 'p.longitude')} AS cell_fine, {cell('coarse', 'p.latitude', 'p.longitude')} AS cell_coarse FROM prim p JOIN cluster c ON c.source = p.source AND c.ord = p.ord)"""


def scored(name: str, pairs: str) -> str:
    """CTEs that end in ``name``: ``pairs`` (a_ord, b_ord, cell) with rounded scores."""
    sides = [("core", "core"), ("company_norm", "facility_owner_norm"), ("company_norm", "company_norm"), ("facility_name_norm", "facility_name_norm"), ("city_norm", "city_norm")]
    texts = " UNION ALL ".join(f"SELECT x.{a} AS a, y.{b} AS b FROM {pairs} p JOIN site x ON x.source = 'A' AND x.ord = p.a_ord JOIN site y ON y.source = 'B' AND y.ord = p.b_ord" for a, b in sides)
    joins = " ".join(f"JOIN {name}_t t{k} ON t{k}.a = x.{a} AND t{k}.b = y.{b}" for k, (a, b) in enumerate(sides))
    total = "capped * 0.45::DOUBLE + comp * 0.35::DOUBLE + name * 0.12::DOUBLE + city * 0.08::DOUBLE + CASE WHEN state_match THEN 3.0::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN postal_match THEN 4.0::DOUBLE ELSE 0.0::DOUBLE END"
    return f"""{token_set(f'{name}_t', texts)},
{name}_5 AS (SELECT p.*, CASE WHEN x.number <> '' AND y.number <> '' AND x.number <> y.number THEN least(t0.score, 70.0::DOUBLE) ELSE t0.score END AS capped, greatest(t1.score, t2.score) AS comp,
  t3.score AS name, t4.score AS city, x.state_norm <> '' AND x.state_norm = y.state_norm AS state_match, x.postal_code_norm <> '' AND x.postal_code_norm = y.postal_code_norm AS postal_match
  FROM {pairs} p JOIN site x ON x.source = 'A' AND x.ord = p.a_ord JOIN site y ON y.source = 'B' AND y.ord = p.b_ord {joins}),
{name} AS MATERIALIZED (SELECT a_ord, b_ord, cell, {half_even('capped', 2)} AS address_score, {half_even('comp', 2)} AS company_score, {half_even('name', 2)} AS facility_name_score,
  {half_even('city', 2)} AS city_score, state_match, postal_match, {half_even(f'least({total}, 100.0::DOUBLE)', 2)} AS combined_score FROM {name}_5)"""


def greedy(name: str, edges: str, order: str) -> str:
    """CTEs that end in ``name``: the edges that greedy takes one after the other."""
    free = "NOT list_contains(g.ua, e.a_ord) AND NOT list_contains(g.ub, e.b_ord)"
    return f"""{name}_e AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {order}, a_ord, b_ord) AS i FROM {edges}),
{name}_g AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS ua, CAST([] AS BIGINT[]) AS ub, false AS won UNION ALL
  SELECT e.i, CASE WHEN {free} THEN list_append(g.ua, e.a_ord) ELSE g.ua END, CASE WHEN {free} THEN list_append(g.ub, e.b_ord) ELSE g.ub END, {free} FROM {name}_g g JOIN {name}_e e ON e.i = g.i + 1),
{name} AS MATERIALIZED (SELECT e.* EXCLUDE (i) FROM {name}_e e JOIN {name}_g g ON g.i = e.i WHERE g.won)"""


def cells_of(name: str, a: str, b: str, column: str) -> str:
    return f"""{name} AS MATERIALIZED (SELECT a_ord, b_ord, min(cell) AS cell FROM (SELECT ord AS a_ord, unnest({column}) AS cell FROM {a}) x JOIN (SELECT ord AS b_ord, unnest({column}) AS cell FROM {b}) y USING (cell) GROUP BY a_ord, b_ord)"""


def ways(fine: bool) -> str:
    (a1, c1), (a2, t2), (a3, c3), (c4, n4, t4) = config.RULES.fine if fine else config.RULES.coarse
    return f"((address_score >= {a1} AND company_score >= {c1}) OR (address_score >= {a2} AND city_score >= {t2}) OR (address_score >= {a3} AND company_score >= {c3}) OR (company_score >= {c4} AND facility_name_score >= {n4} AND city_score >= {t4}))"


LABEL = """CASE WHEN combined_score >= 84 OR (address_score >= 90 AND company_score >= 70) THEN 'Highly likely match'
  WHEN combined_score >= 70 OR (address_score >= 84 AND company_score >= 55) THEN 'Medium confidence match'
  WHEN combined_score >= 56 OR address_score >= 78 OR company_score >= 88 THEN 'Low confidence match' END"""


def chain() -> str:
    """All CTEs of the cascade; a query reads the one it needs."""
    left = lambda s, k, before: f"{s}{k} AS MATERIALIZED (SELECT * FROM {before} x WHERE x.ord NOT IN (SELECT {s[0]}_ord FROM {'fine' if k == 1 else 'coarse' if k == 2 else 'review'}))"
    text = f"""{normalized()}, {consolidate('prim', 'us', 'key')}, {clusters()}, {consolidate('fuz', 'again', 'key')},
site0 AS (SELECT *, {core()} AS core FROM fuz), site AS MATERIALIZED (SELECT *, {number()} AS number FROM site0),
a0 AS (SELECT * FROM site WHERE source = 'A'), b0 AS (SELECT * FROM site WHERE source = 'B'),
{cells_of('fine_c', 'a0', 'b0', 'cells_fine')}, {scored('fine_s', 'fine_c')}, fine_k AS (SELECT * FROM fine_s WHERE {ways(True)}), {greedy('fine', 'fine_k', 'combined_score DESC, address_score DESC')},
{left('a', 1, 'a0')}, {left('b', 1, 'b0')},
{cells_of('coarse_c', 'a1', 'b1', 'cells_coarse')}, {scored('coarse_s', 'coarse_c')}, coarse_k AS (SELECT * FROM coarse_s WHERE {ways(False)}), {greedy('coarse', 'coarse_k', 'combined_score DESC, address_score DESC')},
{left('a', 2, 'a1')}, {left('b', 2, 'b1')},
near_1 AS MATERIALIZED (SELECT x.ord AS a_ord, y.ord AS b_ord FROM a2 x JOIN b2 y ON x.city_norm = y.city_norm AND x.state_norm = y.state_norm
  UNION SELECT x.ord, y.ord FROM a2 x JOIN b2 y ON x.postal_code_norm <> '' AND x.postal_code_norm = y.postal_code_norm),
poor AS (SELECT x.ord, x.state_norm FROM a2 x LEFT JOIN (SELECT a_ord, count(*) AS n FROM near_1 GROUP BY a_ord) c ON c.a_ord = x.ord WHERE coalesce(c.n, 0) < 8 AND x.state_norm <> ''),
firsts AS (SELECT ord, state_norm FROM b2 WHERE state_norm <> '' QUALIFY row_number() OVER (PARTITION BY state_norm ORDER BY ord) <= 250),
review_c AS MATERIALIZED (SELECT *, '' AS cell FROM (SELECT * FROM near_1 UNION SELECT p.ord, f.ord FROM poor p JOIN firsts f USING (state_norm)) u),
{scored('review_s', 'review_c')},
review_k AS (SELECT * FROM (SELECT *, {LABEL} AS manual_label FROM review_s WHERE combined_score >= 50 OR address_score >= 80 OR company_score >= 88) l WHERE manual_label IS NOT NULL),
{greedy('review', 'review_k', 'combined_score DESC')}, {left('a', 3, 'a2')}, {left('b', 3, 'b2')}"""
    return f"WITH RECURSIVE {text}\n"
