"""DuckDB SQL for the registered queries, written apart from the operators."""

_ID = lambda kind, key: f"'{kind}-' || lpad(({key})::VARCHAR, 10, '0')"

FOREST = f"""
forest AS (
  SELECT {_ID(1, 'r_regionkey')} AS territory_id, (r_regionkey + 1)::VARCHAR AS code, r_name AS official_name, lower(r_name) AS normalized_name, 'county' AS territory_type, 'county_uat' AS administrative_role, 1 AS level, NULL::VARCHAR AS parent_id, {_ID(1, 'r_regionkey')} AS county_id, 'active' AS status, 'RO0' || lpad(r_regionkey::VARCHAR, 2, '0') AS nuts FROM region
  UNION ALL SELECT {_ID(2, 'n_nationkey')}, (n_nationkey + 100)::VARCHAR, n_name, lower(n_name), ['municipality', 'city', 'commune'][n_nationkey % 3 + 1], 'local_uat', 2, {_ID(1, 'n_regionkey')}, {_ID(1, 'n_regionkey')}, 'active', NULL FROM nation
  UNION ALL SELECT {_ID(3, 'c_custkey')}, (2 * c_custkey + 1000)::VARCHAR, c_name, lower(c_name), 'village', 'locality', 3, {_ID(2, 'c_nationkey')}, {_ID(1, 'n_regionkey')}, CASE WHEN c_custkey % 17 = 0 THEN 'abolished' ELSE 'active' END, NULL FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT {_ID(4, 's_suppkey')}, (2 * s_suppkey + 1001)::VARCHAR, s_name, lower(s_name), 'component_locality', 'locality', 3, {_ID(2, 's_nationkey')}, {_ID(1, 'n_regionkey')}, 'active', NULL FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
)"""

_BROKEN = (
    FOREST
    + """, broken AS (
  SELECT * REPLACE (
    CASE WHEN territory_type = 'village' AND right(territory_id, 10)::BIGINT % 101 = 0 THEN '2-9999999999' ELSE parent_id END AS parent_id,
    CASE WHEN territory_type = 'village' AND right(territory_id, 10)::BIGINT % 103 = 0 THEN '1-9999999999' ELSE county_id END AS county_id) FROM forest
)"""
)

_UP = """, up AS (
  SELECT c.territory_id AS id, c.parent_id AS ancestor, 1 AS hop FROM {t} c JOIN {t} p ON c.parent_id = p.territory_id
  UNION ALL SELECT up.id, p.parent_id, hop + 1 FROM up JOIN {t} p ON up.ancestor = p.territory_id JOIN {t} g ON p.parent_id = g.territory_id
)"""
_VIEW = "territory_id, official_name, normalized_name, territory_type, administrative_role, level, parent_id, county_id, status"

_RECORDS = """
records AS (
  SELECT (r_regionkey + 1)::INTEGER AS row_number, (r_regionkey + 1)::VARCHAR AS code, r_name AS name, (r_regionkey + 1)::VARCHAR AS county, CASE WHEN r_regionkey = 4 THEN '888888' ELSE '0' END AS parent, 40 AS type, 1 AS level, CASE WHEN r_regionkey = 2 THEN 'BAD' ELSE 'RO0' || lpad(r_regionkey::VARCHAR, 2, '0') END AS nuts FROM region
  UNION ALL SELECT n_nationkey + 100, (n_nationkey + 100)::VARCHAR, n_name, (n_regionkey + 1)::VARCHAR, (n_regionkey + 1)::VARCHAR, n_nationkey % 3 + 1, 2, CASE WHEN n_nationkey % 7 <> 0 THEN 'RO0' || lpad(n_regionkey::VARCHAR, 2, '0') END FROM nation
  UNION ALL SELECT (2 * c_custkey + 1000)::INTEGER, (2 * c_custkey + CASE WHEN c_custkey % 97 = 0 THEN 998 ELSE 1000 END)::VARCHAR, c_name, CASE WHEN c_custkey % 53 = 0 THEN '99' ELSE (n_regionkey + 1)::VARCHAR END,
    CASE WHEN c_custkey % 113 = 1 THEN (2 * c_custkey + 1002)::VARCHAR WHEN c_custkey % 113 = 2 THEN (2 * c_custkey + 998)::VARCHAR WHEN c_custkey % 89 = 0 THEN '999999' WHEN c_custkey % 83 = 0 THEN '0' WHEN c_custkey % 79 = 0 THEN (n_regionkey + 1)::VARCHAR ELSE (c_nationkey + 100)::VARCHAR END,
    CASE WHEN c_custkey % 71 = 0 THEN 77 WHEN c_custkey % 73 = 0 THEN 2 ELSE 11 END, 3,
    CASE WHEN c_custkey % 61 = 0 THEN 'XX1' WHEN c_custkey % 67 = 0 THEN 'RO999' ELSE 'RO0' || lpad(n_regionkey::VARCHAR, 2, '0') END FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT (2 * s_suppkey + 1001)::INTEGER, (2 * s_suppkey + 1001)::VARCHAR, s_name, (n_regionkey + 1)::VARCHAR, (s_nationkey + 100)::VARCHAR, CASE WHEN s_suppkey % 199 = 7 THEN 40 ELSE 9 END, 3, CASE WHEN s_suppkey % 41 = 0 THEN '' ELSE 'RO0' || lpad(n_regionkey::VARCHAR, 2, '0') END FROM supplier JOIN nation ON s_nationkey = n_nationkey
), numbered AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY row_number) AS nth FROM records),
own AS (SELECT * EXCLUDE (nth), CASE WHEN parent <> '0' THEN parent END AS up FROM numbered WHERE nth = 1),
each_row AS (SELECT *, CASE WHEN parent <> '0' THEN parent END AS up FROM records),
joined AS (SELECT o.*, p.level AS up_level, p.county AS up_county, p.code IS NOT NULL AS found FROM each_row o LEFT JOIN own p ON o.up = p.code),
kinds(type, kind, role, want, uat) AS (VALUES (1, 'municipality', 'local_uat', 2, true), (2, 'city', 'local_uat', 2, true), (3, 'commune', 'local_uat', 2, true), (4, 'municipality', 'local_uat', 2, true), (5, 'city', 'local_uat', 2, true), (6, 'sector', 'administrative_subdivision', 3, false), (9, 'component_locality', 'locality', 3, false), (10, 'component_locality', 'locality', 3, false), (11, 'village', 'locality', 3, false), (17, 'component_locality', 'locality', 3, false), (18, 'component_locality', 'locality', 3, false), (19, 'village', 'locality', 3, false), (22, 'village', 'locality', 3, false), (23, 'village', 'locality', 3, false), (40, 'county', 'county_uat', 1, true)),
checked AS (
  SELECT *, code::BIGINT AS v, (11 - list_sum(list_transform([[1, 10], [2, 100], [3, 1000], [5, 10000], [7, 100000]], lambda x: ((code::BIGINT // x[2]) % 10 * x[1]) // 10 + ((code::BIGINT // x[2]) % 10 * x[1]) % 10)) % 10) % 10 = code::BIGINT % 10 AND code::BIGINT < 1000000 AS valid FROM records
)"""


def _found(rule: str, severity: str, entity: str, detail: str, source: str) -> str:
    return f"SELECT 'SIRUTA_{rule}' AS rule, '{severity}' AS severity, ({entity})::VARCHAR AS entity, ({detail})::VARCHAR AS detail FROM {source}"


_DUP = _found("DUPLICATE_CODE", "blocker", "code", "row_number", "numbered WHERE nth > 1")
_TYPE = [
    _found("UNKNOWN_TYPE", "blocker", "code", "type", "records LEFT JOIN kinds USING (type) WHERE kind IS NULL"),
    _found("TYPE_LEVEL_MISMATCH", "blocker", "code", "level", "records JOIN kinds USING (type) WHERE want <> level"),
]
_PARENT = [
    _found("REQUIRED_PARENT_MISSING", "blocker", "code", "level", "joined WHERE level > 1 AND up IS NULL"),
    _found("PARENT_MISSING", "blocker", "code", "up", "joined WHERE up IS NOT NULL AND NOT found"),
    _found("ROOT_PARENT_INVALID", "blocker", "code", "parent", "joined WHERE up IS NOT NULL AND level = 1"),
    _found("PARENT_LEVEL_INVALID", "blocker", "code", "up_level", "joined WHERE found AND level > 1 AND up_level <> level - 1"),
    _found("PARENT_COUNTY_MISMATCH", "blocker", "code", "up_county", "joined WHERE found AND county IS DISTINCT FROM up_county"),
    _found("COUNTY_MISSING", "blocker", "code", "county", "records WHERE county NOT IN (SELECT county FROM records WHERE type = 40)"),
]


def _known(source: str) -> str:
    return f"(SELECT county, arg_min(nuts, row_number) AS known FROM {source} WHERE nuts <> '' GROUP BY county)"


def _nuts(source: str) -> list[str]:
    return [
        _found("NUTS_FORMAT_INVALID", "blocker", "code", "nuts", f"{source} WHERE nuts <> '' AND NOT regexp_full_match(nuts, 'RO[0-9A-Z]{{3}}')"),
        _found("NUTS_COUNTY_CONFLICT", "blocker", "code", "nuts", f"{source} JOIN {_known(source)} USING (county) WHERE nuts <> '' AND nuts <> known"),
        _found("NUTS_DUPLICATE_COUNTY_IDENTIFIER", "blocker", "NULL", "known || ':' || c", f"(SELECT known, string_agg(county, ',' ORDER BY county) AS c, count(*) AS k FROM {_known(source)} GROUP BY known) WHERE k > 1"),
        _found("DUPLICATE_COUNTY_CODE", "blocker", "code", "b || ',' || code", "(SELECT *, lag(code) OVER (PARTITION BY county ORDER BY row_number) AS b FROM records WHERE type = 40) WHERE b <> code"),
    ]


_WALK = """, walk AS (
  SELECT code AS start, up AS above, [code] AS path FROM own WHERE up IS NOT NULL
  UNION ALL SELECT start, o.up, list_append(path, o.code) FROM walk JOIN own o ON o.code = above WHERE above <> start AND o.up IS NOT NULL AND NOT list_contains(path, above)
)"""
_CYCLE = _found("HIERARCHY_CYCLE", "blocker", "NULL", "array_to_string(path, '>') || '>' || start", "walk WHERE above = start AND start = list_min(path)")
_SEEN = "(SELECT count(*) AS n, count(*) FILTER (level = 1) AS l1, count(*) FILTER (level = 2) AS l2, count(*) FILTER (level = 3) AS l3, count(*) FILTER (NOT valid) AS bad, count(*) FILTER (coalesce(nuts, '') = '') AS missing, (SELECT count(DISTINCT known) FROM " + _known("records") + ") AS nuts3 FROM checked)"
_VOLUME = [
    _found("LEVEL_VOLUME_CHANGED", "blocker", "NULL", f"'{k}:' || l{k}", f"{_SEEN} WHERE l{k} <> {want}") for k, want in ((1, 5), (2, 24), (3, 1))
] + [
    _found("TOTAL_VOLUME_CHANGED", "blocker", "NULL", "n", f"{_SEEN} WHERE n <> 1"),
    _found("NUTS3_VOLUME_CHANGED", "blocker", "NULL", "nuts3", f"{_SEEN} WHERE nuts3 <> 6"),
    _found("CHECKSUM_OFFICIAL_WARNING", "warning", "NULL", "bad", f"{_SEEN} WHERE bad = 3"),
    _found("CHECKSUM_WARNING_COUNT_CHANGED", "warning", "NULL", "bad", f"{_SEEN} WHERE bad <> 3"),
    _found("NUTS_MISSING_VALUES", "warning", "NULL", "missing", f"{_SEEN} WHERE missing = 4"),
    _found("NUTS_MISSING_COUNT_CHANGED", "warning", "NULL", "missing", f"{_SEEN} WHERE missing <> 4"),
]


def _with(ctes: str, parts: str | list[str], recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' * recursive}{ctes} " + (parts if isinstance(parts, str) else " UNION ALL ".join(parts))


_ALL = [_DUP, *_TYPE, *_nuts("records"), *_PARENT, _CYCLE, *_VOLUME]
_CORRECTED = ", corrected AS (SELECT * REPLACE (CASE WHEN county = '1' AND nuts = 'RO999' THEN 'RO000' WHEN county = '2' AND nuts = 'RO001' THEN 'RO001' WHEN county = '4' AND nuts = 'RO003' THEN 'RO093' ELSE nuts END AS nuts) FROM records)"


def _correction(county: str, source: str, count: int, unit: str) -> list[str]:
    anchor = f"(SELECT * FROM own WHERE code = '{unit}')"
    return [
        _found("REVIEWED_NUTS_CORRECTION_MISSING", "blocker", f"'{unit}'", "NULL", f"(SELECT 1) WHERE NOT EXISTS {anchor}"),
        _found("REVIEWED_NUTS_CORRECTION_MISMATCH", "blocker", "code", "NULL", f"{anchor} WHERE county <> '{county}' OR type <> 40 OR level <> 1 OR nuts IS DISTINCT FROM '{source}'"),
        _found("REVIEWED_NUTS_CORRECTION_COUNT_CHANGED", "blocker", "code", "n", f"{anchor}, (SELECT count(*) AS n FROM records WHERE county = '{county}' AND nuts = '{source}') WHERE n <> {count}"),
    ]


_OVERRIDES = ", overrides(code, otype, olevel, okind, orole, ouat) AS (VALUES ('1146', 77, 3, 'sector', 'administrative_subdivision', false), ('1142', 77, 3, 'village', 'locality', false), ('1', 12, 1, 'county', 'county_uat', true), ('77777777', 1, 1, 'county', 'county_uat', true)), typed AS (SELECT records.*, CASE WHEN o.otype = records.type AND olevel = level THEN okind ELSE kind END AS k, CASE WHEN o.otype = records.type AND olevel = level THEN orole ELSE role END AS r, CASE WHEN o.otype = records.type AND olevel = level THEN olevel ELSE want END AS w, CASE WHEN o.otype = records.type AND olevel = level THEN ouat ELSE uat END AS u, otype, olevel FROM records LEFT JOIN kinds USING (type) LEFT JOIN overrides o USING (code))"

_IDENTITY = "identities AS (SELECT (2 * c_custkey + 1000)::VARCHAR AS code, c_custkey % 11 AS m, c_custkey FROM customer)"
_SNAPSHOTS = """
before AS (SELECT (2 * c_custkey + 1000)::VARCHAR AS code, c_name AS name, c_mktsegment AS segment, sha256(c_name || '|' || c_mktsegment || '|') AS record_hash FROM customer WHERE c_custkey % 29 <> 0),
shaped AS (SELECT c_custkey, (2 * c_custkey + 1000)::VARCHAR AS code, CASE WHEN c_custkey % 37 = 0 THEN c_name || ' II' ELSE c_name END AS name, CASE WHEN c_custkey % 41 = 0 THEN 'OTHER' ELSE c_mktsegment END AS segment FROM customer WHERE c_custkey % 31 <> 0),
after AS (SELECT code, name, segment, sha256(name || '|' || segment || '|' || CASE WHEN c_custkey % 43 = 0 THEN 're-typed' ELSE '' END) AS record_hash FROM shaped),
changes AS (
  SELECT coalesce(b.code, a.code) AS code, CASE WHEN b.code IS NULL THEN 'added' WHEN a.code IS NULL THEN 'removed' WHEN a.name <> b.name OR a.segment <> b.segment THEN 'changed' ELSE 'unchanged' END AS kind,
    CASE WHEN b.code IS NULL OR a.code IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.name <> b.name THEN 'name' END, CASE WHEN a.segment <> b.segment THEN 'segment' END) END AS fields,
    coalesce(a.record_hash <> b.record_hash, false) AS source_changed FROM before b FULL JOIN after a ON a.code = b.code
),
ratios AS (
  SELECT *, abs(added - removed) / greatest(removed + changed + unchanged, 1) AS total_ratio, removed / greatest(removed + changed + unchanged, 1) AS removed_ratio, changed / greatest(removed + changed + unchanged, 1) AS changed_ratio FROM (
    SELECT count(*) FILTER (kind = 'added') AS added, count(*) FILTER (kind = 'removed') AS removed, count(*) FILTER (kind = 'changed') AS changed, count(*) FILTER (kind = 'unchanged') AS unchanged, count(*) FILTER (source_changed) AS source_changed FROM changes)
)"""

_IDENTIFIERS = """
wanted AS (SELECT 'ro.ins.siruta' AS scheme, (c_custkey % 700)::VARCHAR AS value, CASE WHEN c_custkey % 3 = 0 THEN '2024-01-01' END AS valid_from, 't' || (c_custkey // 1000)::VARCHAR AS territory_id FROM customer WHERE c_custkey % 5 <> 0),
known AS (SELECT 'ro.ins.siruta' AS scheme, (c_custkey % 700)::VARCHAR AS value, CASE WHEN c_custkey % 3 = 0 THEN '2024-01-01' END AS valid_from, 't' || (c_custkey // 1000)::VARCHAR AS territory_id FROM customer WHERE c_custkey % 4 <> 0)"""

_HITS = "hits AS (SELECT user_id AS client, event_id AS id, epoch_ms(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts), event_id) AS k FROM events)"
_CELL = "(c_custkey % 100)::DOUBLE AS x, (c_custkey // 100)::DOUBLE AS y"
SLUG = "regexp_replace(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
_FOLDED = "translate(lower(coalesce(text, '')), 'ăâîșțşţ', 'aaistst')"
_CLOSED = [("0.0.0.0", 8), ("10.0.0.0", 8), ("100.64.0.0", 10), ("127.0.0.0", 8), ("169.254.0.0", 16), ("172.16.0.0", 12), ("192.0.0.0", 24), ("192.0.2.0", 24), ("192.168.0.0", 16), ("198.18.0.0", 15), ("198.51.100.0", 24), ("203.0.113.0", 24), ("224.0.0.0", 4), ("240.0.0.0", 4)]


def _closed() -> str:
    out = []
    for base, prefix in _CLOSED:
        first = 0
        for x in base.split("."):
            first = first * 256 + int(x)
        out.append(f"n >> {32 - prefix} = {first >> (32 - prefix)}")
    return " OR ".join(out)


_URL = "CASE page_id % 7 WHEN 0 THEN url || '#part' WHEN 1 THEN replace(url, '://', '://user:word@') WHEN 2 THEN 'ftp://data.example.org/x' WHEN 3 THEN 'not a url' WHEN 4 THEN 'https://data.example.org:8443/x' WHEN 5 THEN 'https://DATA.example.org/x?y=1' ELSE url END"

_LISTED = "CASE WHEN nuts <> '' THEN 'eu.eurostat.nuts=' || nuts || ',' ELSE '' END || 'ro.ins.siruta=' || code"


def _detail(relation: str, hop: int, where: str) -> str:
    return f"SELECT '{relation}' AS relation, {hop} AS hop, territory_id, official_name, official_name AS short_name, {_LISTED} AS identifiers FROM forest WHERE {where}"


_CANONICAL = f"""
SELECT i.tid AS territory_id, c.code, c.name AS official_name, c.name AS short_name, kind AS territory_type, c.level AS administrative_level, p.tid AS parent_territory_id, q.tid AS county_territory_id, uat AS is_uat,
  CASE WHEN role = 'county_uat' AND c.nuts <> '' THEN 'eu.eurostat.nuts=' || c.nuts || ',' ELSE '' END || 'ro.ins.siruta=' || c.code AS identifiers, CASE WHEN role = 'county_uat' AND c.nuts IS DISTINCT FROM r.nuts THEN r.nuts END AS corrected_from
FROM corrected c JOIN records r USING (row_number) LEFT JOIN kinds k ON c.type = k.type LEFT JOIN ids i ON i.code = c.code LEFT JOIN ids p ON p.code = c.parent AND c.parent <> '0'
LEFT JOIN (SELECT county, arg_max(code, row_number) AS cc FROM records WHERE type = 40 GROUP BY county) m ON m.county = c.county LEFT JOIN ids q ON q.code = m.cc"""
_IDS = ", ids AS (SELECT DISTINCT code, 't-' || code AS tid FROM records WHERE code::BIGINT % 7 <> 0 OR code::BIGINT < 200)"


def _import(table: str, back: str, fits: str) -> str:
    faults = f"(SELECT count(*) FROM (SELECT territory_id FROM {table} GROUP BY 1 HAVING count(*) > 1)) + (SELECT count(*) FROM (SELECT code FROM {table} GROUP BY 1 HAVING count(*) > 1))"
    faults += "".join(f" + (SELECT count(*) FROM {table} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT territory_id FROM {table}))" for c in ("parent_id", "county_id"))
    ok = f"c = 0 AND {fits}"
    return f"SELECT CASE WHEN {ok} THEN 'accepted' ELSE 'rejected' END AS status, CASE WHEN {ok} THEN n ELSE 0 END::BIGINT AS accepted, CASE WHEN {ok} THEN 0 ELSE n END::BIGINT AS rejected, c::BIGINT AS conflicts, 'r2' AS release_id, '{'b' * 64}' AS manifest_sha256, CASE WHEN {ok} THEN {back} END::VARCHAR AS rollback_release_id FROM (SELECT count(*) AS n, {faults} AS c FROM {table})"


ORACLES = {
    "search_fold_page": _with(FOREST, f"SELECT {_VIEW} FROM forest WHERE status = 'active' AND contains(normalized_name, 'customer#00000000') ORDER BY territory_id LIMIT 50"),
    "search_filters": _with(FOREST, f"SELECT {_VIEW} FROM forest WHERE territory_type = 'component_locality' AND county_id = '1-0000000001'"),
    "search_code_lookup": _with(FOREST, "SELECT territory_id, official_name, code AS siruta FROM forest WHERE code = '1102'"),
    "keyset_next_page": _with(FOREST, f"SELECT {_VIEW} FROM forest WHERE territory_id > '3-0000000100' ORDER BY territory_id LIMIT 200"),
    "keyset_page_info": _with(FOREST, "SELECT (SELECT count(*) FROM forest) AS total, least(count(*), 200) AS returned, CASE WHEN count(*) > 200 THEN rtrim(translate(base64((SELECT territory_id FROM forest WHERE territory_id > '3-0000000100' ORDER BY 1 LIMIT 1 OFFSET 199)::BLOB), '+/', '-_'), '=') END AS next_cursor FROM forest WHERE territory_id > '3-0000000100'"),
    "children_list": _with(FOREST, "SELECT territory_id, official_name FROM forest WHERE parent_id = '2-0000000005'"),
    "root_list": _with(FOREST, "SELECT territory_id, official_name FROM forest WHERE parent_id IS NULL"),
    "ancestors_chain": _with(FOREST + _UP.format(t="forest"), "SELECT * FROM up", True),
    "descendants_page": _with(FOREST + _UP.format(t="forest"), "SELECT id AS territory_id, hop FROM up WHERE ancestor = '1-0000000001' AND id > '2-0000000003' ORDER BY id LIMIT 200", True),
    "subtree_counts": _with(FOREST + _UP.format(t="forest"), "SELECT ancestor, count(*) AS n, max(hop) AS depth FROM up GROUP BY ancestor", True),
    "partition_check": _with(_BROKEN + _UP.format(t="broken"), "SELECT b.territory_id AS id, n_roots, root, county_id FROM broken b LEFT JOIN (SELECT id, count(*) AS n_roots, min(root) AS root FROM (SELECT id, ancestor AS root FROM up WHERE ancestor IN (SELECT territory_id FROM broken WHERE parent_id IS NULL) UNION ALL SELECT territory_id, territory_id FROM broken WHERE parent_id IS NULL) GROUP BY id) t ON b.territory_id = t.id WHERE coalesce(n_roots, 0) <> 1 OR root IS DISTINCT FROM county_id", True),
    "unresolved_parents": _with(_BROKEN, "SELECT territory_id AS id, parent_id AS parent FROM broken WHERE parent_id IS NOT NULL AND parent_id NOT IN (SELECT territory_id FROM broken)"),
    "cycle_detect": f"WITH e AS (SELECT c_custkey AS k, c_custkey + CASE c_custkey % 10 WHEN 1 THEN 1 WHEN 2 THEN -1 WHEN 3 THEN 1 WHEN 4 THEN 1 WHEN 5 THEN -2 WHEN 6 THEN -1 END AS p FROM customer), f AS (SELECT a.k, b.k AS k2, c.k AS k3, a.p AS p1, b.p AS p2, c.p AS p3 FROM e a LEFT JOIN e b ON a.p = b.k LEFT JOIN e c ON b.p = c.k) SELECT {_ID(3, 'k')} AS id, {_ID(3, 'CASE WHEN p2 = k THEN least(k, k2) ELSE least(k, k2, k3) END')} AS cycle, CASE WHEN p2 = k THEN CASE WHEN k < k2 THEN 0 ELSE 1 END WHEN k < least(k2, k3) THEN 0 WHEN k3 < least(k, k2) THEN 1 ELSE 2 END AS position FROM f WHERE p2 = k OR p3 = k",
    "leaf_units": _with(FOREST, "SELECT territory_id FROM forest f WHERE level < 3 AND NOT EXISTS (SELECT 1 FROM forest c WHERE c.level < 3 AND c.parent_id = f.territory_id)"),
    "slug_paths": _with(FOREST, f"SELECT a.territory_id, concat_ws('/', {SLUG.format('c.official_name')}, {SLUG.format('b.official_name')}, {SLUG.format('a.official_name')}) AS path, a.level AS depth FROM forest a LEFT JOIN forest b ON a.parent_id = b.territory_id LEFT JOIN forest c ON b.parent_id = c.territory_id"),
    "release_counts": _with(FOREST, "SELECT count(*) AS territories, count(*) FILTER (administrative_role = 'county_uat') AS counties, count(*) FILTER (administrative_role = 'local_uat') AS local_uats, count(*) FILTER (administrative_role = 'locality') AS localities, count(*) FILTER (administrative_role = 'administrative_subdivision') AS subdivisions FROM forest"),
    "reference_faults": _with(_BROKEN, "SELECT territory_id, 'PARENT_ID_MISSING' AS fault FROM broken WHERE parent_id NOT IN (SELECT territory_id FROM broken) UNION ALL SELECT territory_id, 'COUNTY_ID_MISSING' FROM broken WHERE county_id NOT IN (SELECT territory_id FROM broken) UNION ALL SELECT min(territory_id), 'CODE_REPEATED' FROM broken GROUP BY code HAVING count(*) > 1"),
    "level_profile": _with(FOREST, "SELECT level, count(*) AS n, count(DISTINCT nuts) AS nuts FROM forest GROUP BY level"),
    "dup_codes": _with(_RECORDS, _DUP),
    "type_findings": _with(_RECORDS + _OVERRIDES, [
        _found("UNKNOWN_TYPE", "blocker", "code", "type", "typed WHERE k IS NULL"),
        _found("TYPE_LEVEL_MISMATCH", "blocker", "code", "level", "typed WHERE k IS NOT NULL AND w <> level"),
        _found("REVIEWED_TYPE_OVERRIDE_MISMATCH", "blocker", "code", "NULL", "typed WHERE otype IS NOT NULL AND NOT (otype = type AND olevel = level)"),
        _found("REVIEWED_TYPE_OVERRIDE_MISSING", "blocker", "code", "NULL", "overrides WHERE code NOT IN (SELECT code FROM records)"),
    ]),
    "type_override": _with(_RECORDS + _OVERRIDES, "SELECT row_number, code, k AS territory_type, r AS administrative_role, w AS expected_level, u AS is_uat FROM typed WHERE code IN ('1146', '1142', '1', '1144')"),
    "nuts_findings": _with(_RECORDS + _CORRECTED, _nuts("corrected") + _correction("1", "RO999", 1, "1") + _correction("2", "RO001", 2, "123456") + _correction("4", "RO003", 3, "103") + _correction("5", "RO004", 5, "5")),
    "parent_findings": _with(_RECORDS, _PARENT),
    "checksum_warnings": _with(_RECORDS, "SELECT row_number, code FROM checked WHERE NOT valid ORDER BY row_number LIMIT 20"),
    "checksum_by_code": _with(_RECORDS, "SELECT row_number, valid FROM checked"),
    "volume_findings": _with(_RECORDS, _VOLUME),
    "findings_by_rule": _with(_RECORDS + _WALK, "SELECT rule, severity, count(*) AS n FROM (" + " UNION ALL ".join(_ALL) + ") GROUP BY ALL", True),
    "descendants_filtered": _with(FOREST + _UP.format(t="forest"), "SELECT territory_id, official_name, hop FROM up JOIN forest ON id = territory_id WHERE ancestor = '1-0000000002' AND territory_type = 'village' AND status = 'abolished'", True),
    "unit_detail": _with(FOREST, [_detail("self", 0, "territory_id = '2-0000000005'"), _detail("ancestor", 1, "territory_id = (SELECT parent_id FROM forest WHERE territory_id = '2-0000000005')"), _detail("child", 1, "parent_id = '2-0000000005'")]),
    "canonical_units": _with(_RECORDS + _CORRECTED + _IDS, _CANONICAL),
    "changelog_row": _with(_SNAPSHOTS, "SELECT *, 'release-1' AS previous_release_id, true AS baseline, false AS skipped, NULL::VARCHAR AS reason FROM ratios"),
    "changelog_first": _with(_SNAPSHOTS, "SELECT count(*) AS added, 0::BIGINT AS removed, 0::BIGINT AS changed, 0::BIGINT AS unchanged, 0::BIGINT AS source_changed, NULL::DOUBLE AS total_ratio, NULL::DOUBLE AS removed_ratio, NULL::DOUBLE AS changed_ratio, NULL::VARCHAR AS previous_release_id, false AS baseline, false AS skipped, NULL::VARCHAR AS reason FROM after UNION ALL SELECT 0, 0, 0, 0, 0, NULL, NULL, NULL, NULL, NULL, true, 'validation_blocked'"),
    "changelog_codes": _with(_SNAPSHOTS, "SELECT kind, code::BIGINT AS position, code FROM (SELECT kind, code FROM changes WHERE kind <> 'unchanged' UNION ALL SELECT 'source_record_changed', code FROM changes WHERE source_changed)"),
    "consumer_import": _with(_BROKEN, [_import("forest", "'r1'", "true"), _import("broken", "'r1'", "true"), _import("forest", "NULL", "false")]),
    "sums_parse": "SELECT nullif(regexp_extract(line, '^([0-9a-f]{64})  (.+)$', 2), '') AS name, nullif(regexp_extract(line, '^([0-9a-f]{64})  (.+)$', 1), '') AS sha256 FROM (SELECT CASE doc_id % 5 WHEN 0 THEN upper(sha256(coalesce(text, ''))) || '  a' WHEN 1 THEN sha256(coalesce(text, '')) || ' a' WHEN 2 THEN '' ELSE sha256(coalesce(text, '')) || '  part ' || doc_id END AS line FROM documents)",
    "count_reconciliation": _with(FOREST, "SELECT coalesce(e.name, o.name) AS name, expected, observed FROM (VALUES ('county', 5), ('municipality', 1), ('sector', 6)) e(name, expected) FULL JOIN (SELECT territory_type AS name, count(*) AS observed FROM forest GROUP BY 1) o ON e.name = o.name WHERE expected IS DISTINCT FROM observed"),
    "release_forms": r"""
WITH e AS (SELECT *, (2000 + event_id % 100) || '.' || lpad((event_id % 13)::VARCHAR, 2, '0') || '.' || lpad((event_id % 32)::VARCHAR, 2, '0') || '.' || (event_id % 3) AS rid,
  CASE WHEN event_id % 4 = 0 THEN 'v1.2.3' ELSE (event_id % 20) || '.' || (event_id % 3) || '.0' END AS version, sha256(event_id::VARCHAR) AS sha FROM events)
SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN (event_id % 20)::INTEGER END AS major,
  CASE WHEN event_id % 3 <> 0 THEN try_strptime(left(rid, 10), '%Y.%m.%d')::DATE END AS released, event_id % 4 = 1 AS exact,
  CASE WHEN event_id % 3 = 0 THEN least(event_id % 50 * 1000, 30000) ELSE least(500 * (1 << (event_id % 7)::INTEGER), 8000) END::BIGINT AS backoff,
  CASE event_id % 3 WHEN 0 THEN 'text/html' WHEN 2 THEN 'application/json' END AS media_type, CASE WHEN event_id % 2 = 0 THEN sha END AS stored,
  sha256('{"commit":"' || repeat('c', 40) || '","snapshot":"' || sha || '","transformation":"' || (event_id % 5) || '"}') AS idempotency_key,
  'limit=' || (event_id % 9) || CASE WHEN event_id % 2 = 0 THEN '&q=a' ELSE '' END AS query,
  CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN 'rollback' ELSE 'promote' END AS move, CASE WHEN event_id % 3 = 1 THEN 'a b' END AS optional,
  true AS is_sha, event_id % 4 <> 0 AS is_semver FROM e""",
    "cycle_findings": _with(_RECORDS + _WALK, f"SELECT *, '1.0.0' AS rule_version, 'import_run' AS entity_kind FROM ({_CYCLE})", True),
    "findings_summary": _with(_RECORDS + _WALK, "SELECT count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'blocker') AS blockers, CASE WHEN count(*) FILTER (severity <> 'warning') > 0 THEN 'blocked' ELSE 'passed' END AS status FROM (" + " UNION ALL ".join(_ALL) + ")", True),
    "first_and_last": _with(_RECORDS, "SELECT code, arg_min(name, row_number) AS first_name, arg_max(name, row_number) AS last_name, min(row_number) AS position FROM records GROUP BY code"),
    "identity_decisions": _with(_IDENTITY, "SELECT code, CASE WHEN m IN (0, 1) THEN 'matched' WHEN m IN (4, 10) THEN 'create' ELSE 'needs_review' END AS decision, CASE WHEN m IN (0, 1) THEN 'a' || code WHEN m = 4 THEN 'p' || code WHEN m = 10 THEN 'new' END AS territory_id, CASE m WHEN 2 THEN 'IDENTITY_ACTIVE_PROPOSAL_CONFLICT' WHEN 3 THEN 'IDENTITY_AMBIGUOUS_ACTIVE' WHEN 5 THEN 'IDENTITY_PROPOSAL_HISTORICAL_CONFLICT' WHEN 6 THEN 'IDENTITY_AMBIGUOUS_PROPOSAL' WHEN 7 THEN 'IDENTITY_HISTORICAL_REUSE_REVIEW' WHEN 8 THEN 'IDENTITY_HISTORICAL_REUSE_REVIEW' WHEN 9 THEN 'IDENTITY_HISTORICAL_REUSE_REVIEW' END AS rule FROM identities"),
    "identity_ledger": _with(_IDENTITY, "SELECT code, CASE WHEN m IN (0, 1) THEN 'a' || code WHEN m IN (5, 7) THEN least('h' || code, CASE WHEN code::INT % 22 = 0 THEN 'old' ELSE 'z' END) ELSE 'old' END AS territory_id FROM identities WHERE m IN (0, 1, 5, 7) OR code::INT % 22 = 0"),
    "ambiguous_bindings": _with(_IDENTITY, "SELECT 'code' AS side, code AS key, 2::BIGINT AS n FROM identities WHERE m = 6"),
    "diff_changes": _with(_SNAPSHOTS, "SELECT code, kind, fields, source_changed FROM changes"),
    "diff_ratios": _with(_SNAPSHOTS, "SELECT * FROM ratios"),
    "diff_gates": _with(_SNAPSHOTS, "SELECT 'SIRUTA_DIFF_TOTAL_MASS_CHANGE' AS rule, total_ratio AS ratio FROM ratios WHERE total_ratio > 0.02 UNION ALL SELECT 'SIRUTA_DIFF_REMOVALS_MASS_CHANGE', removed_ratio FROM ratios WHERE removed_ratio > 0.01 UNION ALL SELECT 'SIRUTA_DIFF_RECORDS_MASS_CHANGE', changed_ratio FROM ratios WHERE changed_ratio > 0.25"),
    "canonical_hash": "SELECT o_orderkey, sha256('{\"custkey\":' || o_custkey || ',\"none\":null,\"orderkey\":' || o_orderkey || ',\"priority\":\"' || o_orderpriority || '\",\"status\":\"' || o_orderstatus || '\"}') AS sha256 FROM orders",
    "csv_rows": "SELECT p_partkey, '\"' || p_partkey || '\",\"' || replace(p_name, '\"', '\"\"') || '\",\"' || p_brand || '\",\"' || p_type || '\",\"' || p_size || '\",\"\"' AS line FROM part",
    "canonical_nested": """SELECT *, sha256(line) AS sha256 FROM (SELECT c_custkey, '{"identifiers":[{"scheme":"name","value":"' || c_name || '"},{"scheme":null,"value":"' || c_mktsegment || '"}],"marks":{"a":' || c_nationkey || ',"z":' || c_custkey
        || '},"whose":{"market":{"key":' || c_custkey || ',"segment":"' || c_mktsegment || '"},"nation":' || c_nationkey || '}}' AS line FROM customer)""",
    "merkle_tree": """WITH h AS (SELECT sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}') AS hash, count(*) AS n FROM orders GROUP BY 1),
        d AS (SELECT CASE WHEN count(*) <= 64 THEN 0 WHEN count(*) <= 1024 THEN 1 WHEN count(*) <= 16384 THEN 2 WHEN count(*) <= 262144 THEN 3 ELSE 4 END AS depth FROM h),
        l0 AS (SELECT left(hash, depth) AS prefix, sum(n)::BIGINT AS lines, sha256(string_agg(hash || ':' || n, chr(10) ORDER BY hash)) AS sha256 FROM h, d GROUP BY 1), """
    + ", ".join(f"l{i} AS (SELECT left(prefix, length(prefix) - 1) AS prefix, sum(lines)::BIGINT AS lines, sha256(string_agg(prefix || ':' || sha256, chr(10) ORDER BY prefix)) AS sha256 FROM l{i - 1} WHERE prefix <> '' GROUP BY 1)" for i in range(1, 5))
    + " SELECT length(prefix) AS level, prefix, lines, sha256 FROM (" + " UNION ALL ".join(f"SELECT * FROM l{i}" for i in range(5)) + ")",
    "ndjson_rows": "SELECT n_nationkey, '{\"n_name\":\"' || n_name || '\",\"n_nationkey\":' || n_nationkey || ',\"n_regionkey\":' || n_regionkey || '}' AS line FROM nation",
    "identifiers_explode": _with(FOREST, "SELECT territory_id, 'ro.ins.siruta' AS scheme, code AS value, status FROM forest UNION ALL SELECT territory_id, 'eu.eurostat.nuts', nuts, status FROM forest WHERE nuts IS NOT NULL"),
    "artifact_sums": "SELECT 'doc-' || doc_id AS name, sha256(text) || '  doc-' || doc_id AS line, strlen(text)::BIGINT AS size FROM documents",
    "bundle_verify": "SELECT 'doc-' || doc_id AS name, CASE doc_id % 10 WHEN 1 THEN 'UNEXPECTED' WHEN 2 THEN 'MISSING' WHEN 3 THEN 'SIZE' ELSE 'HASH' END AS fault FROM documents WHERE doc_id % 10 IN (1, 2, 3, 4)",
    "latest_per_key": "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    "scd2_close_open": _with(_SNAPSHOTS, "SELECT b.code AS key, b.name, b.segment, '2024-01-01' AS recorded_from, CASE WHEN a.code IS NULL OR a.name <> b.name OR a.segment <> b.segment THEN '2024-07-01' END AS recorded_to FROM before b LEFT JOIN after a USING (code) UNION ALL SELECT a.code, a.name, a.segment, '2024-07-01', NULL FROM after a LEFT JOIN before b USING (code) WHERE b.code IS NULL OR a.name <> b.name OR a.segment <> b.segment"),
    "null_safe_anti": _with(_IDENTIFIERS, "SELECT DISTINCT w.* FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.scheme = w.scheme AND k.value = w.value AND k.valid_from IS NOT DISTINCT FROM w.valid_from)"),
    "conflict_join": _with(_IDENTIFIERS, "SELECT DISTINCT w.scheme, w.value, w.territory_id, k.territory_id AS other_id FROM wanted w JOIN known k ON w.scheme = k.scheme AND w.value = k.value AND w.territory_id <> k.territory_id"),
    "semi_exists": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
    "channel_state": "SELECT event_type AS channel, user_id AS release FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1",
    "url_policy": f"WITH u AS (SELECT page_id, {_URL} AS url FROM pages), p AS (SELECT *, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS authority FROM u), q AS (SELECT *, lower(split_part(split_part(authority, '@', -1), ':', 1)) AS host, CASE WHEN contains(authority, ':') AND NOT contains(authority, '@') THEN split_part(authority, ':', -1) ELSE CASE WHEN scheme = 'https' THEN '443' ELSE '80' END END AS port FROM p) SELECT page_id, CASE WHEN scheme = '' OR host = '' THEN 'URL_INVALID' WHEN contains(authority, '@') THEN 'URL_CREDENTIALS' WHEN scheme <> 'https' THEN 'PROTOCOL_BLOCKED' WHEN host <> 'data.example.org' THEN 'HOST_BLOCKED' WHEN port <> '443' THEN 'PORT_BLOCKED' WHEN contains(url, '#') THEN 'URL_FRAGMENT' END AS error FROM q",
    "cidr_public": f"SELECT event_id, NOT ({_closed()}) AS public FROM (SELECT event_id, (event_id * 2654435761) % 4294967296 AS n FROM events)",
    "xff_client_key": "SELECT event_id, CASE WHEN event_id % 5 = 1 THEN '10.0.0.' || user_id WHEN event_id % 5 = 2 THEN '2.2.2.2' WHEN event_id % 2 = 0 THEN '9.9.9.9' ELSE 'unknown' END AS one, CASE WHEN event_id % 5 = 2 THEN '10.0.0.' || user_id WHEN event_id % 2 = 0 THEN '9.9.9.9' ELSE 'unknown' END AS two FROM events",
    "etag": "SELECT event_id, '\"' || left(sha256(repeat('a', 64) || 'q=' || event_type), 32) || '\"' AS etag FROM events",
    "cursor_codec": _with(FOREST, "SELECT territory_id, rtrim(translate(base64(territory_id::BLOB), '+/', '-_'), '=') AS cursor, territory_id AS decoded FROM forest"),
    "rate_limit_fixed_window": f"WITH RECURSIVE {_HITS}, f AS (SELECT client, id, k, 1::BIGINT AS n, t + 21600000 AS ends FROM hits WHERE k = 1 UNION ALL SELECT h.client, h.id, h.k, CASE WHEN h.t >= f.ends THEN 1 ELSE f.n + 1 END, CASE WHEN h.t >= f.ends THEN h.t + 21600000 ELSE f.ends END FROM f JOIN hits h ON h.client = f.client AND h.k = f.k + 1) SELECT client, id, n, n > 1 AS limited, greatest(1 - n, 0) AS remaining FROM f",
    "props_json": "SELECT event_id, (props::JSON ->> 'k')::INTEGER AS k FROM events, range(2)",
    "text_fold": f"SELECT doc_id, md5({_FOLDED}) AS folded, md5(coalesce(nullif(regexp_replace(regexp_replace({_FOLDED}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'unit')) AS slug FROM documents",
    "short_names": "SELECT n_nationkey, CASE n_nationkey % 4 WHEN 2 THEN 'Comuna' ELSE n_name END AS short_name, CASE n_nationkey % 4 WHEN 0 THEN 'județul ' || lower(n_name) WHEN 1 THEN 'oraș ' || lower(n_name) WHEN 2 THEN 'comuna' ELSE lower(n_name) END AS search_name, 'SECTOR ' || n_nationkey AS match_name FROM nation",
    "code_candidates": "SELECT c_custkey, concat_ws('|', c_name || '/0' || c_nationkey, regexp_extract(c_name, '[0-9]+'), CASE WHEN c_custkey::VARCHAR <> regexp_extract(c_name, '[0-9]+') THEN c_custkey END, '0' || c_nationkey, CASE WHEN c_nationkey <> c_custkey THEN c_nationkey END) AS candidates FROM customer",
    "redact": "SELECT conv_id, turn, md5(left('at [redacted] key [redacted] jwt [redacted] ' || text, 500)) AS message FROM conversations",
    "media_sniff": "SELECT 'pages' AS source, page_id AS id, 'application/xml' AS media_type FROM pages UNION ALL SELECT 'events', event_id, 'application/json' FROM events UNION ALL SELECT 'part', p_partkey, 'text/csv' FROM part UNION ALL SELECT 'nation', n_nationkey, 'application/octet-stream' FROM nation",
    "int_parse": "SELECT event_id, CASE WHEN event_id % 6 IN (0, 1) AND event_id BETWEEN 1 AND 5000 THEN event_id END AS value, CASE event_id % 6 WHEN 2 THEN 'CODE is required' WHEN 3 THEN 'CODE must be an integer' WHEN 4 THEN 'CODE is outside the safe integer range' WHEN 5 THEN 'CODE must be greater than zero' ELSE CASE WHEN event_id = 0 THEN 'CODE must be greater than zero' WHEN event_id > 5000 THEN 'CODE must be at most 5000' END END AS error, CASE event_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 3 END AS level, CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 50 WHEN 2 THEN 200 ELSE CASE WHEN event_id % 300 = 0 THEN 50 ELSE least(event_id % 300, 200) END END::INTEGER AS page FROM events",
    "geo_bounds": f"SELECT c_nationkey, min(x) AS min_x, min(y) AS min_y, max(x) + 1 AS max_x, max(y) + 1 AS max_y, count(*)::DOUBLE AS area FROM (SELECT c_nationkey, {_CELL} FROM customer) GROUP BY c_nationkey",
    "geo_svg_path": f"SELECT c_custkey, printf('M%.2f,%.2f L%.2f,%.2f L%.2f,%.2f L%.2f,%.2f L%.2f,%.2f Z', 18 + x, 218 - y, 19 + x, 218 - y, 19 + x, 217 - y, 18 + x, 217 - y, 18 + x, 218 - y) AS path, 18 + (5 * x + 2) / 5 AS label_x, 236 - (18 + (5 * y + 2) / 5) AS label_y FROM (SELECT c_custkey, {_CELL} FROM customer)",
    "geo_feature_lines": f"SELECT c_custkey, '{{\"geometry\":{{\"coordinates\":[[[[' || x || ',' || y || '],[' || x + 1 || ',' || y || '],[' || x + 1 || ',' || y + 1 || '],[' || x || ',' || y + 1 || '],[' || x || ',' || y || ']]]],\"type\":\"MultiPolygon\"}},\"properties\":{{\"detailLevel\":\"full\",\"geometryKind\":\"source\",\"territoryId\":\"' || {_ID(3, 'c_custkey')} || '\"}},\"type\":\"Feature\"}}' AS line FROM (SELECT c_custkey, {_CELL} FROM customer)",
    "chunk_numbers": "SELECT o_orderkey, (row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1) // 500 AS chunk FROM orders",
    "geo_match_cascade": f"SELECT 'r' || r_regionkey AS feature, {_ID(1, 'r_regionkey')} AS territory_id, CASE WHEN r_regionkey % 2 = 0 THEN 'code' ELSE 'county name' END AS how FROM region UNION ALL SELECT 'n' || lpad(n_nationkey::VARCHAR, 3, '0'), CASE WHEN n_nationkey % 3 = 0 OR n_nationkey % 5 <> 4 THEN {_ID(2, 'n_nationkey')} END, CASE WHEN n_nationkey % 3 = 0 THEN 'code' WHEN n_nationkey % 5 <> 4 THEN 'unit name' END FROM nation UNION ALL SELECT 'z' || lpad(n_nationkey::VARCHAR, 3, '0'), {_ID(2, 'n_nationkey')}, 'code' FROM nation WHERE n_nationkey % 12 = 0",
    "geo_conflicts": f"SELECT {_ID(2, 'n_nationkey')} AS territory_id, 'z' || lpad(n_nationkey::VARCHAR, 3, '0') AS feature, 'n' || lpad(n_nationkey::VARCHAR, 3, '0') AS kept FROM nation WHERE n_nationkey % 12 = 0",
    "geo_derive_gate": f"SELECT county_id, expected, actual, snapshots, CASE WHEN actual < expected THEN 'incomplete-children' WHEN snapshots <> 1 THEN 'ambiguous-snapshot' ELSE 'derivable' END AS verdict FROM (SELECT {_ID(1, 'n_regionkey')} AS county_id, count(*) AS expected, count(s) AS actual, count(DISTINCT s) AS snapshots FROM (SELECT n_regionkey, CASE WHEN c_nationkey % 5 <> 3 OR c_custkey % 50 <> 0 THEN CASE WHEN c_nationkey % 7 = 2 AND c_custkey % 2 = 0 THEN 's2' ELSE 's1' END END AS s FROM customer JOIN nation ON c_nationkey = n_nationkey) GROUP BY ALL)",
}
