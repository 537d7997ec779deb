"""Operators on small cases: nulls, ties, empty inputs, and behaviour that no table shows."""

import hashlib
import io
import json
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from grovespark.functions import hashing, network, numbers, shapes, text
from grovespark.operators import bundle, diff, governance, graph, history, identity, limiter, matching, merkle, parsing, release, search, validation
from grovespark.sources import snapshots, workbook


def values(spark, column, inputs):
    """The column (of x) for each input."""
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("x"))).collect()]


def test_text(spark):
    assert values(spark, text.fold, ["ȘTEFAN Țară Şi ţ", None, "ÂÎĂ"]) == ["stefan tara si t", "", "aia"]
    assert values(spark, text.slugify, ["Alba Iulia", "--", "Cluj-Napoca (mun.)"]) == ["alba-iulia", "unit", "cluj-napoca-mun"]
    assert values(spark, text.normalize_text, ["  Şcoala  ﬁ ", None]) == ["Școala fi", ""]
    assert values(spark, text.optional_text, [" ", None, "a  b"]) == [None, None, "a b"]
    assert values(spark, text.normalize_header, ["﻿den  loc", None]) == ["DEN LOC", ""]
    assert values(spark, text.short_name, ["Municipiul Cluj", "JUDEŢUL  ALBA", "Comuna", None]) == ["Cluj", "ALBA", "Comuna", ""]
    assert values(spark, text.match_name, ["Sectorul 1", "Orașul Ștei"]) == ["SECTOR 1", "STEI"]
    assert values(spark, text.code_candidates, [" RO-0012/7 ", None, "12"]) == [["RO-0012/7", "0012", "12", "7"], [], ["12"]]
    assert values(spark, text.redact, ["see postgres://a:b@c/d now", "x" * 600]) == ["see [redacted] now", "x" * 500]
    assert values(spark, text.csv_cell, ['a"b', None]) == ['"a""b"', '""']
    assert values(spark, text.media_type_header, ["Text/CSV; charset=x", "", None]) == ["text/csv", None, None]
    assert values(spark, lambda x: text.display_label(x, {"a": "A"}), ["a", "b", None]) == ["A", "b", None]
    made = spark.range(1).select(text.query_string(F.create_map(*map(F.lit, ["q", "a b", "z", "", "c", "1"])))).first()[0]
    assert made == "c=1&q=a+b"


def test_numbers(spark):
    got = values(spark, lambda x: numbers.source_integer(x, "N", most=50), ["12.0", "", "-1", "51", "0", "99999999999999999999", "007"])
    assert [r.value for r in got] == [12, None, None, None, None, None, 7]
    assert [r.error and r.error.split(" ", 1)[1] for r in got] == [None, "is required", "must be an integer", "must be at most 50", "must be greater than zero", "is outside the safe integer range", None]
    assert values(spark, lambda x: numbers.source_integer(x, "N", optional=True)["error"], ["", None]) == [None, None]
    assert values(spark, numbers.level, ["NIVEL 2", "3", "1.0", "4", None]) == [2, 3, 1, None, None]
    assert values(spark, numbers.checksum_valid, ["1", "2", "1000000", None, "x"]) == [True, False, False, False, False]
    assert values(spark, numbers.clamp_limit, ["1.9", "abc", "9" * 30, "-4", None, "120"]) == [1, 50, 200, 50, 50, 120]
    assert values(spark, numbers.semver_major, ["2.10.1", "2.1"]) == [2, None]
    assert values(spark, lambda x: numbers.release_date(x).cast("string"), ["2026.07.22.1", "2026.13.01.1", "2026.07.22"]) == ["2026-07-22", None, None]
    assert values(spark, numbers.utc_milliseconds, ["2026-07-22T10:00:00.000Z", "2026-02-30T10:00:00.000Z", "2026-07-22T10:00:00Z", None]) == [True, False, False, False]
    ids = values(spark, lambda x: numbers.uuid7(F.lit(1_700_000_000_000), x), ["a", "b"])
    assert ids[0] != ids[1] and all(values(spark, lambda x: x.rlike(numbers.UUID7), ids))
    assert [r[0] for r in spark.range(1, 7).select(numbers.backoff_ms(F.col("id"))).collect()] == [500, 1000, 2000, 4000, 8000, 8000]


def test_network(spark):
    shown = {"8.8.8.8": True, "10.1.2.3": False, "172.32.0.1": True, "255.255.255.255": False, "::1": False, "fe80::1": False, "2606:4700::1": True, "::ffff:127.0.0.1": False, "::ffff:8.8.4.4": True, "name": False, "1.2.3": False, None: False}
    assert values(spark, network.is_public, list(shown)) == list(shown.values())
    urls = {"https://data.example.org/x": None, "https://u@data.example.org/": "URL_CREDENTIALS", "http://data.example.org/": "PROTOCOL_BLOCKED", "https://other.org/": "HOST_BLOCKED", "https://data.example.org:444/": "PORT_BLOCKED", "https://data.example.org/#a": "URL_FRAGMENT", "x": "URL_INVALID", None: "URL_INVALID"}
    assert values(spark, lambda x: network.url_error(x, hosts=("data.example.org",)), list(urls)) == list(urls.values())
    sha = "ab" + "0" * 62
    assert values(spark, lambda x: network.storage_uri(x, "s3", "b"), [f"s3://b/src/ab/{sha}.xlsx", f"s3://b/src/aa/{sha}.xlsx"]) == [sha, None]


def test_hashing(spark):
    assert values(spark, lambda x: hashing.canonical_json({"b": x, "a": F.lit(1)}), ["é", None]) == ['{"a":1,"b":"é"}', '{"a":1,"b":null}']
    assert values(spark, lambda x: hashing.decode_cursor(hashing.encode_cursor(x)), ["a", "ab", "abc", "ț?>"]) == ["a", "ab", "abc", "ț?>"]


def test_shapes(spark):
    square = '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[1,1],[2,1],[2,2],[1,2],[1,1]]]}'
    assert values(spark, lambda x: shapes.area(shapes.parse(x)), [square, '{"type":"Point","coordinates":[1,2]}', None]) == [15.0, None, None]
    box = values(spark, lambda x: shapes.bounds(shapes.parse(x)), [square])[0]
    assert tuple(box) == (0, 0, 4, 4)
    assert values(spark, lambda x: F.size(shapes.exterior_rings(shapes.parse(x))), [square]) == [1]


def test_media_types(spark):
    def packed(*names):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for n in names:
                z.writestr(n, "x")
        return bytearray(out.getvalue())

    cases = [(packed("[Content_Types].xml", "xl/workbook.xml"), snapshots.XLSX), (packed("a.txt"), snapshots.ZIP), (b' {"a": 1}', snapshots.JSON), (b"{no", snapshots.BYTES), (b"<a/>", snapshots.XML), (b"a;b\n1;2\n", snapshots.CSV), (b"", snapshots.BYTES), (b"a;b\n\x00", snapshots.BYTES), (b"<" + b"x" * 8190 + "é".encode(), snapshots.XML), (b"\xff\xfe", snapshots.BYTES)]
    df = spark.createDataFrame([(i, bytearray(c)) for i, (c, _) in enumerate(cases)], "i int, c binary")
    assert [r[0] for r in df.orderBy("i").select(snapshots.media_type(F.col("c"))).collect()] == [t for _, t in cases]


def sheet(rows):
    strings = []

    def cell(x):
        strings.append(x)
        return len(strings) - 1

    body = "".join(f'<row r="{n}">' + "".join(f'<c r="{chr(65 + i)}{n}" t="s"><v>{cell(x)}</v></c>' for i, x in enumerate(cells) if x is not None) + "</row>" for n, cells in rows)
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", "<Types/>")
        z.writestr("xl/workbook.xml", "<workbook/>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {space}><sheetData>{body}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {space}>" + "".join(f"<si><t>{s}</t></si>" for s in strings) + "</sst>")
    return out.getvalue()


def test_workbook_to_records(spark, tmp_path):
    good = ["1017", "JUDEŢUL  ALBA", "0", "1", "1", "40", "NIVEL 1", "0", "7", "1", "0123456789012", "ro001"]
    data = sheet([(1, list(parsing.HEADERS)), (2, [None] * 12), (4, good), (5, [*good[:10], "12", None]), (6, [*good, "extra"])])
    path = tmp_path / "book.xlsx"
    path.write_bytes(data)
    rows = workbook.read_workbooks(spark, str(path)).cache()
    assert rows.where("row_number = 1").select(parsing.header_matches(F.col("cells"))).first()[0]
    out = {r.row_number: r for r in parsing.parse_rows(rows.where("row_number > 1")).collect()}
    assert sorted(out) == [4, 5, 6]
    assert out[4].record.name == "JUDEȚUL ALBA" and out[4].record.nuts == "RO001" and out[4].record.level == 1 and out[4].parse_status == "parsed"
    assert out[5].parse_status == "invalid" and out[5].error == "FSL must be 13 digits" and out[5].record is None
    assert out[6].extra_cells and not out[4].extra_cells
    assert out[4].record_hash != out[5].record_hash
    found = validation.row_rules(parsing.parse_rows(rows.where("row_number > 1")))
    assert [f.count() for f in found] == [1, 1]
    assert workbook.container_error(data) is None
    assert workbook.container_error(b"x") == "NOT_A_ZIP"


def test_search_page(spark):
    units = spark.createDataFrame([(f"{i:02d}", f"Unit {i}", f"unit {i}") for i in range(7)], "territory_id string, official_name string, normalized_name string")
    first = search.page(units, 3).collect()
    assert [r.territory_id for r in first] == ["00", "01", "02"]
    info = search.page_info(units, 3, after="03").first()
    assert (info.total, info.returned, info.next_cursor) == (7, 3, None)
    late = search.page_info(units, 3, after="zz").first()
    assert (late.total, late.returned, late.next_cursor) == (7, 0, None)
    assert search.matching(units, q="").count() == 7 and search.matching(units, q="ÛNIT").count() == 0


EDGES = [("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "z"), ("z", "x"), ("t", "x"), ("o", "gone"), ("s", "s")]


def test_graph(spark):
    edges = spark.createDataFrame(EDGES, "id string, parent string")
    up = {(r.id, r.ancestor): r.hop for r in graph.ancestors(edges).collect() if r.id in "abco"}
    assert up == {("b", "a"): 1, ("c", "b"): 1, ("c", "a"): 2}
    assert {(r.id, r.cycle) for r in graph.cycles(edges).collect()} == {("x", "x"), ("y", "x"), ("z", "x"), ("s", "s")}
    assert {r.id for r in graph.unresolved_parents(edges).collect()} == {"o"}
    below = {(r.ancestor, r.id) for r in graph.descendants(edges).collect()}
    assert {("x", "t"), ("x", "y"), ("x", "z"), ("a", "c")} <= below and ("x", "x") not in below
    assert {(r.id, r.position) for r in graph.cycles(edges).where("cycle = 'x'").collect()} == {("x", 0), ("y", 1), ("z", 2)}
    asked = spark.createDataFrame([("x",), ("a",)], "id string")
    assert {(r.ancestor, r.id) for r in graph.subtree(edges, asked).collect()} == {(x, y) for x, y in below if x in "xa"}
    none = edges.limit(0)
    assert graph.subtree(none, asked).count() == 0
    assert graph.ancestors(none).count() == 0 and graph.cycles(none).count() == 0


def test_deep_chain(spark):
    """Ancestors stop after 32 hops; descendants and subtrees do not."""
    chain = spark.createDataFrame([(f"{i:03d}", f"{i - 1:03d}" if i else None) for i in range(40)], "id string, parent string")
    assert graph.ancestors(chain).where("id = '039'").count() == 32
    assert graph.descendants(chain).where("ancestor = '000'").count() == 39
    assert graph.subtree(chain, spark.createDataFrame([("000",)], "id string")).agg({"hop": "max"}).first()[0] == 39


def test_validation_cases(spark):
    """Cases in which a first look at a record misleads."""
    P = validation.Profile
    rows = [
        (1, "10", "A", "1", "777", 40, 1, "bad"),  # a root under an unknown parent; its badly formed value is the county's first
        (2, "20", "B", "1", "10", 3, 2, "RO001"),
        (3, "20", "B again", "1", "0", 3, 2, "RO001"),  # the later row of a code is judged as well
        (4, "10", "A again", "1", "0", 40, 1, "bad"),  # the same county once more: no second county
        (5, "30", "C", "2", "20", 11, 3, ""),
    ]
    r = spark.createDataFrame(rows, "row_number int, code string, name string, county string, parent string, type int, level int, nuts string")
    found = {(x.rule.removeprefix("SIRUTA_"), x.entity) for x in validation.all_findings(r, P(corrections={"1": ("RO001", "RO002", 2, "30")})).collect()}
    assert {("ROOT_PARENT_INVALID", "10"), ("PARENT_MISSING", "10"), ("NUTS_FORMAT_INVALID", "10"), ("NUTS_COUNTY_CONFLICT", "20"), ("REQUIRED_PARENT_MISSING", "20"), ("DUPLICATE_CODE", "20"), ("PARENT_COUNTY_MISMATCH", "30"), ("COUNTY_MISSING", "30"), ("REVIEWED_NUTS_CORRECTION_MISMATCH", "30")} <= found
    assert not {x for x in found if x[0] in ("DUPLICATE_COUNTY_CODE", "REVIEWED_NUTS_CORRECTION_COUNT_CHANGED", "REVIEWED_NUTS_CORRECTION_MISSING")}
    again = validation.county_rules(r, P(corrections={"1": ("RO001", "RO002", 9, "99")}))
    assert [x.rule for x in again.collect()] == ["SIRUTA_REVIEWED_NUTS_CORRECTION_MISSING"]
    ring = spark.createDataFrame([(1, "5", "A", "1", "6", 11, 3, None), (2, "6", "B", "1", "7", 11, 3, None), (3, "7", "C", "1", "5", 11, 3, None)], r.schema)
    assert [x.detail for x in validation.cycle_rule(ring).collect()] == ["5>6>7>5"]
    assert validation.all_findings(r.limit(0), P()).count() == 0


def test_slugs(spark):
    rows = [("1", None, "Same", "10"), ("2", None, "same!", "11"), ("3", "1", "Same", "12")]
    got = graph.slugs(spark.createDataFrame(rows, "territory_id string, parent_id string, official_name string, code string"))
    assert {r.territory_id: r.slug for r in got.collect()} == {"1": "same", "2": "same-11", "3": "same"}


def test_identity_of_nothing(spark):
    codes = spark.createDataFrame([("7",)], "code string")
    index = spark.createDataFrame([], "code string, territory_id string, status string, valid_to date, origin string")
    a, b = (identity.reconcile(codes, index).first() for _ in range(2))
    assert a == b and a.decision == "create"


def test_diff_without_previous(spark):
    new = spark.createDataFrame([("1", "a", "h")], "code string, name string, record_hash string")
    d = diff.changes(new.limit(0), new, ("name",))
    assert [r.kind for r in d.collect()] == ["added"]
    r = diff.ratios(d).first()
    assert (r.added, r.removed_ratio, r.total_ratio) == (1, 0, 1)
    with pytest.raises(ValueError):
        diff.gates(diff.ratios(d), total=2)


def test_history_is_idempotent(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", None)], "key string, name string").withColumns({"recorded_from": F.to_timestamp(F.lit("2024-01-01")), "recorded_to": F.lit(None).cast("timestamp")})
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None), ("d", "1")], "key string, name string")
    once = history.revise(old, new, ("name",), F.to_timestamp(F.lit("2024-02-01"))).cache()
    again = history.revise(once, new, ("name",), F.to_timestamp(F.lit("2024-03-01")))
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))
    assert history.current(once).count() == 4 and once.count() == 5


def test_bundle(spark, tmp_path):
    units = spark.createDataFrame([(i, f'n"{i}', None) for i in range(50)], "k int, name string, none string")
    folder = str(tmp_path / "bundle")
    release.write_lines(release.csv_lines(units, ("k", "name", "none"), "k"), folder, "k", header='"k","name","none"')
    manifest = release.artifacts(spark, folder).cache()
    assert manifest.count() >= 2
    assert release.verify(manifest, release.artifacts(spark, folder)).count() == 0
    lines = spark.read.text(folder, recursiveFileLookup=True)
    assert lines.count() == 51 and lines.where(F.col("value") == '"3","n""3",""').count() == 1
    other = manifest.withColumn("sha256", F.lit("0" * 64))
    assert release.verify(manifest, other).select("fault").distinct().first()[0] == "HASH"
    parsed = release.parse_sums(release.sums(manifest)).where("name IS NOT NULL")
    assert parsed.count() == manifest.count()
    with pytest.raises(Exception):
        release.write_lines(release.csv_lines(units, ("k",), "k"), folder, "k")


def test_matching_prefers_codes(spark):
    units = spark.createDataFrame([("c1", "1", "Județul Alba", "county", "c1"), ("u1", "10", "Zlatna", "city", "c1"), ("u2", "11", "Dublu", "city", "c1"), ("u3", "12", "dublu", "commune", "c1")], "territory_id string, code string, name string, territory_type string, county_id string")
    features = spark.createDataFrame([("f1", "x", "ALBA", 2, None), ("f2", "RO 0010", "wrong", 3, "f1"), ("f3", None, "Zlatna", 3, "f1"), ("f4", None, "Dublu", 3, "f1"), ("f5", None, None, 3, None)], "feature string, code string, name string, rank int, upper string")
    got = matching.match(features, units)
    assert {r.feature: (r.territory_id, r.how) for r in got.collect()} == {"f1": ("c1", "county name"), "f2": ("u1", "code"), "f3": ("u1", "unit name"), "f4": (None, None), "f5": (None, None)}
    assert [tuple(r) for r in matching.conflicts(got).collect()] == [("u1", "f3", "f2")]


def test_canonical_json_of_nested_values(spark):
    """The same values in any order of fields and keys give one line; nulls stay nulls at every depth."""
    def line(df):
        return [r[0] for r in df.orderBy("n").select(hashing.canonical_json({c: F.col(c) for c in df.columns}, df.schema)).collect()]

    one = spark.sql("SELECT 1 AS n, named_struct('b', 1, 'a', array(named_struct('y', map('q', named_struct('d', 1, 'c', 2), 'p', null), 'x', null), null)) AS v UNION ALL SELECT 2, null")
    two = spark.sql("SELECT named_struct('a', array(named_struct('x', null, 'y', map('p', null, 'q', named_struct('c', 2, 'd', 1))), null), 'b', 1) AS v, 1 AS n UNION ALL SELECT null, 2")
    assert line(one) == line(two) == ['{"n":1,"v":{"a":[{"x":null,"y":{"p":null,"q":{"c":2,"d":1}}},null],"b":1}}', '{"n":2,"v":null}']
    assert line(spark.sql("SELECT 1 AS n, array(array(map(2, 'b', 1, 'a'))) AS v, map() AS e")) == ['{"e":{},"n":1,"v":[[{"1":"a","2":"b"}]]}']


def test_promotion_drift(spark):
    """Each field of a manifest that differs from the approved context has its own verdict; nulls differ from values only."""
    base = {"run": 1, "sha256": "h", "commit": "c", "snapshot": "s", "source_sha256": "f", "approved_by": "me", "approved_at": "t", "rationale": "good"}
    contexts = spark.createDataFrame([{**base, "status": "approved", "fault": None}], ", ".join(f"{k} {'long' if k == 'run' else 'string'}" for k in (*base, "status", "fault")))
    changes = [{}] + [{k: "other"} for k in base if k != "run"] + [{"rationale": None}]
    rows = [{**base, **change, "release_id": f"r{i}", "manifest_sha256": "m", "previous_release_id": None, "published_at": "u"} for i, change in enumerate(changes)]
    names = (*base, "release_id", "manifest_sha256", "previous_release_id", "published_at")
    manifests = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{k} {'long' if k == 'run' else 'string'}" for k in names))
    none = spark.createDataFrame([], "release_id string, status string, manifest_sha256 string, published_at string")
    got = governance.promotion_verdicts(manifests, contexts, none, spark.createDataFrame([], "release string"))
    want = ["promoted"] + ["RELEASE_CONTEXT_DRIFT"] * 4 + ["RELEASE_APPROVAL_DRIFT"] * 4
    assert [r.verdict for r in got.orderBy("release_id").collect()] == want


def test_merkle_tree(spark):
    """One root for the same lines in any order and files; a changed line names the ranges of its old and new hash; odd tables have a root."""
    lines = spark.range(3000).select(F.concat(F.lit("line "), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("line"))
    one, two = merkle.tree(lines, 20), merkle.tree(lines.repartition(7), 20)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) and merkle.differing(one, two).isEmpty()
    assert one.agg(F.max("level")).first()[0] == 2 and [r.lines for r in one.where("level = 0").collect()] == [3000]
    changed = lines.withColumn("line", F.when(F.col("line") == "line 77", "line 77!").otherwise(F.col("line")))
    want = {hashlib.sha256(x).hexdigest()[:2] for x in (b"line 77", b"line 77!")}
    assert {r.prefix for r in merkle.differing(one, merkle.tree(changed, 20)).collect()} == want
    root = lambda df: tuple(merkle.root(df).first())
    assert root(lines.limit(0)) == (0, hashlib.sha256(b"").hexdigest())
    odd = [spark.createDataFrame(rows, "line string") for rows in ([(None,)], [("",)], [("",), ("",)])]
    assert len({root(df) for df in odd}) == 3


def test_limiter(spark):
    hits = spark.createDataFrame([("a", i, t) for i, t in enumerate([0, 10, 20, 100, 105, 300])] + [("b", 9, 50), (None, 10, 1)], "client string, id long, at long")
    got = {(r.client, r.id): (r.n, r.limited, r.remaining, r.resets_at) for r in limiter.limited(hits, 100, 2).collect()}
    assert got == {("a", 0): (1, False, 1, 100), ("a", 1): (2, False, 0, 100), ("a", 2): (3, True, 0, 100), ("a", 3): (1, False, 1, 200), ("a", 4): (2, False, 0, 200), ("a", 5): (1, False, 1, 400), ("b", 9): (1, False, 1, 150), ("unknown", 10): (1, False, 1, 101)}


def test_cycles_of_many_lengths(spark):
    """Rings of one to forty units, with long tails that lead to them or end at a missing parent."""
    rng = random.Random(5)
    rings, edges = {}, []
    for size in (1, 2, 3, 7, 16, 17, 40):
        ids = [f"r{size:02}-{i:02}" for i in rng.sample(range(size), size)]
        edges += list(zip(ids, ids[1:] + ids[:1]))
        k = ids.index(min(ids))
        rings |= {x: (min(ids), i) for i, x in enumerate(ids[k:] + ids[:k])}
        edges += [(f"t{size}-{i}", f"t{size}-{i + 1}" if i < 20 else ids[0]) for i in range(21)]
    edges += [(f"m{i}", f"m{i + 1}") for i in range(50)]
    rng.shuffle(edges)
    got = graph.cycles(spark.createDataFrame(edges, "id string, parent string"))
    assert {r.id: (r.cycle, r.position) for r in got.collect()} == rings
    assert graph.cycles(spark.createDataFrame([("a", "b"), ("b", None)], "id string, parent string")).count() == 0


def test_records_without_code_keep_their_findings(spark):
    rows = spark.createDataFrame([(1, None, "x", "1", None, 99, 9, None), (2, "5", "y", "1", None, 99, 9, None)], "row_number int, code string, name string, county string, parent string, type int, level int, nuts string")
    found = validation.row_findings(rows, groups=("codes", "types")).where(F.col("rule").endswith("UNKNOWN_TYPE"))
    assert sorted((r.entity is None) for r in found.collect()) == [False, True]


def _folded(rows, window):
    """By the plain fold: {(client, id): (n, resets_at)}. Ids are not repeated."""
    out = {}
    for client in {c for c, _, _ in rows}:
        own = sorted((t, i) for c, i, t in rows if c == client)
        counts, ends, _ = limiter.fold([t for t, _ in own], None, window)
        out |= {(client, i): (n, end) for (_, i), n, end in zip(own, counts, ends)}
    return out


def test_limiter_one_client_has_all_hits(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select(F.lit("one").alias("client"), F.col("event_id").cast("long").alias("id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("at"))
    rows = [tuple(r) for r in events.collect()]
    for window in (60_000, 21_600_000):
        assert {(r.client, r.id): (r.n, r.resets_at) for r in limiter.limited(events, window, 3).collect()} == _folded(rows, window)


def test_limiter_times(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), i, rng.choice([rng.randrange(-300, 300), rng.randrange(5000), 77, -100])) for i in range(700)]
    hits = spark.createDataFrame(rows, "client string, id long, at long").repartition(5)
    for window in (1, 7, 100, 10_000):
        assert {(r.client, r.id): (r.n, r.resets_at) for r in limiter.limited(hits, window, 3).collect()} == _folded(rows, window)
    same = spark.createDataFrame([("a", None, 5)] * 4 + [(None, 1, 5), ("a", 1, None)], "client string, id long, at long")
    assert sorted(r.n for r in limiter.limited(same, 10, 3).collect()) == [1, 1, 2, 3, 4]
    assert limiter.limited(same.limit(0), 10, 3).count() == 0


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(name)


def _streamed(spark, folder, batches, window, lateness):
    """Rows counted by the stream, each batch being one file and one micro-batch; and the folder of its checkpoint."""
    from grovespark.streaming.limiter import limited_stream

    schema = "client string, id long, at long"
    for i, batch in enumerate(batches):
        part = folder / "in" / f"{i:03}.json"
        part.parent.mkdir(exist_ok=True, parents=True)
        part.write_text("".join(json.dumps(dict(zip(("client", "id", "at"), row))) + "\n" for row in batch))
        os.utime(part, (i + 1, i + 1))  # read in this order
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder / "in"))
    q = limited_stream(stream, window, 3, lateness, slot_ms=50).writeStream.format("memory").queryName(folder.name).option("checkpointLocation", str(folder / "cp")).outputMode("append").trigger(availableNow=True).start()
    assert q.awaitTermination(240)
    q.stop()
    return spark.table(folder.name).collect(), str(folder / "cp")


def test_limiter_stream_equals_the_batch_query(spark, tmp_path, rocksdb):
    """One busy client and some others, out of order by less than the lateness, in few and in many micro-batches; the last hit moves the watermark beyond all others."""
    rng = random.Random(4)
    rows = [("busy" if rng.random() < 0.6 else rng.choice(["a", "b", None]), i, rng.randrange(1000, 6000)) for i in range(300)] + [("busy", None, 3000), ("busy", None, 3000), ("a", 400, None)]
    end = ("end", 500, 60_000)
    want = []
    for client in ("busy", "a", "b", limiter.UNKNOWN):
        own = sorted((t, i is not None, i or 0) for c, i, t in rows if (c or limiter.UNKNOWN) == client and t is not None)
        counts, ends, _ = limiter.fold([t for t, *_ in own], None, 400)
        want += [(client, there, i, t, n, e) for (t, there, i), n, e in zip(own, counts, ends)]
    for name, cuts in (("limits_few", 2), ("limits_many", 7)):
        known = sorted(rows, key=lambda r: (r[2] or 0) + rng.randrange(900))
        size = len(known) // cuts + 1
        got, checkpoint = _streamed(spark, tmp_path / name, [known[i : i + size] for i in range(0, len(known), size)] + [[end]], 400, "1 second")
        assert sorted((r.client, r.id is not None, r.id or 0, r.at, r.n, r.resets_at) for r in got) == sorted(want)
        assert not any(r.late for r in got) and all(r.limited == (r.n > 3) and r.remaining == max(3 - r.n, 0) for r in got)
        state = lambda var: spark.read.format("statestore").option("stateVarName", var).load(checkpoint)
        assert state("window").count() == 0  # windows that are over are gone
        assert [r.key.client for r in state("waiting").select("key").distinct().collect()] == ["end"]


def test_limiter_stream_counts_late_hits(spark, tmp_path, rocksdb):
    """A hit that comes after its slot was counted counts at the watermark."""
    batches = [[("a", 1, 1000), ("a", 2, 2000)], [("a", 3, 1900)], [("a", 4, 500)], [("b", 9, 60_000)]]
    got, _ = _streamed(spark, tmp_path / "limits_late", batches, 5000, "0 seconds")
    assert sorted((r.id, r.at, r.n, r.resets_at, r.late) for r in got) == [(1, 1000, 1, 6000, False), (2, 2000, 2, 6000, False), (3, 1900, 3, 6000, True), (4, 500, 4, 6000, True)]


def test_features(spark, tmp_path):
    from grovespark.sources import features

    (tmp_path / "f.json").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"OBJECTID":7,"featureId":"f","name_1":"","name_2":"Alba","nationalCode":"RO1","nationalLevel":"x/2ndOrder"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}},{"type":"Feature","properties":{"OBJECTID":8},"geometry":{"type":"Point","coordinates":[0,1]}}]}')
    a, b = features.read_features(spark, str(tmp_path / "f.json")).orderBy("object_id").collect()
    assert (a.feature, a.code, a.name, a.rank, a.polygons) == ("f", "RO1", "Alba", 2, [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]])
    assert (b.name, b.rank, b.polygons) == (None, None, None)


def test_positions(spark):
    from grovespark.operators import paging

    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(5)
    assert {(r.k, r.position) for r in paging.numbered(rows, "k").collect()} == {(i, i) for i in range(1000)}
    assert paging.numbered(rows.limit(0), "k").count() == 0


def test_catalogue_and_registration(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"result": {"resources": [{"id": "r1", "url": "https://a/x.xlsx", "state": "active"}, {"id": "r2", "url": "https://a/y", "state": "deleted"}]}}')
    refused = lambda i, u: snapshots.catalog_resources(spark, str(tmp_path / "c.json"), i, u).first().refused
    assert (refused("r1", "https://a/x.xlsx"), refused("r1", "https://b"), refused("r2", "https://a/y")) == (None, "RESOURCE_URL_CHANGED", "RESOURCE_INACTIVE")
    known = spark.createDataFrame([("s", "1")], "source string, sha256 string")
    files = spark.createDataFrame([("s", "1"), ("s", "2"), ("s", "2")], "source string, sha256 string")
    assert [tuple(r) for r in snapshots.register(known, files).collect()] == [("s", "2")]


def test_unions_of_polygons(spark):
    ring = lambda *p: "[" + ",".join(f"[{x},{y}]" for x, y in p) + "]"
    left = ring((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))
    turned = ring((2, 0), (2, 2), (4, 2), (4, 0), (2, 0))  # clockwise
    hole = ring((10, 0), (13, 0), (13, 3), (10, 3), (10, 0)), ring((11, 1), (12, 1), (12, 2), (11, 2), (11, 1))
    one = lambda *rings: '{"type":"Polygon","coordinates":[' + ",".join(rings) + "]}"
    rows = spark.createDataFrame([("a", one(left)), ("a", one(turned)), ("b", one(*hole)), ("c", "{}"), ("d", None)], "county string, g string").select("county", shapes.parse(F.col("g")).alias("polygons"))
    edges = matching.union_boundary(rows, "county")
    got = {r.county: (r.edges, r.perimeter, r.area) for r in matching.union_measures(edges, "county").collect()}
    assert got == {"a": (6, 12.0, 8.0), "b": (8, 16.0, 8.0)}
    assert matching.union_boundary(rows.limit(0), "county").count() == 0


def test_governance(spark, tmp_path):
    run = lambda rows, extra: spark.createDataFrame(rows, "run int, " + extra)
    ask = run([(i, "h") for i in range(8)] + [(9, None)], "sha256 string")
    runs = run([(1, "review", "h"), (2, "running", "h"), (3, "review", "g"), (4, "review", "h"), (5, "review", "h"), (6, "approved", "h"), (7, None, "h"), (9, "review", "h")], "status string, sha256 string")
    findings = run([(4, "error"), (1, "warning")], "severity string")
    decisions = run([(1, "matched"), (1, "create"), (6, "create"), (5, "needs_review")], "decision string")
    staged = run([(1, True), (1, True), (1, False), (6, True), (5, True)], "parsed boolean")
    approvals = run([(6, "h")], "sha256 string")
    got = {r.run: r.verdict for r in governance.approval_verdicts(ask, runs, findings, decisions, staged, approvals).collect()}
    assert got == {0: "IMPORT_RUN_NOT_FOUND", 1: "approved", 2: "IMPORT_RUN_NOT_REVIEWABLE", 3: "CANDIDATE_HASH_MISMATCH", 4: "CANDIDATE_HAS_BLOCKERS", 5: "IDENTITY_REVIEW_INCOMPLETE", 6: "replayed", 7: "IMPORT_RUN_NOT_REVIEWABLE", 9: "CANDIDATE_HASH_MISMATCH"}

    rows = spark.range(10).toDF("id")
    folder = f"file://{tmp_path}/staged"
    assert governance.append_once(rows, folder, "k1") and not governance.append_once(rows.limit(1), folder, "k1") and governance.append_once(rows, folder, "k2", 10)
    with pytest.raises(ValueError):
        governance.append_once(rows, folder, "k3", 11)
    assert spark.read.parquet(folder).groupBy("run").count().orderBy("run").collect() == [("k1", 10), ("k2", 10)]

    m = "release_id string, previous_release_id string, published_at string, commit string, repository string, approved_by string, approved_at string, rationale string, sha256 string, uri string, size long"
    good = ("2026.07.22.1", None, "2026-07-22T10:00:00.000Z", "a" * 40, "o/n", "me", "2026-07-22T09:00:00.000Z", "long enough", "b" * 64, "https://data.gov.ro/x", 1)
    assert governance.metadata_faults(spark.createDataFrame([good], m)).count() == 0
    nothing = governance.metadata_faults(spark.createDataFrame([(None,) * 11], m))
    assert {r.fault for r in nothing.collect()} == {"RELEASE_ID", "PUBLISHED_AT", "COMMIT", "REPOSITORY", "APPROVED_BY", "APPROVED_AT", "RATIONALE", "CANDIDATE_SHA256", "SOURCE_URI", "SOURCE_SIZE"}
    units = spark.createDataFrame([("a", "2", 0), ("b", "10", 1), ("c", "9", 2), ("d", None, 3), ("e", "1", 4)], "territory_id string, code string, position long")
    assert [r.territory_id for r in governance.out_of_order(units).collect()] == ["c"]


def test_bundle(spark, tmp_path):
    one = lambda code: [("ro.ins.siruta", "active", code)]
    schema = "territory_id string, code string, position long, snapshot string, identifiers array<struct<scheme string, status string, value string>>, parent_id string, county_id string"
    units = spark.createDataFrame([("a", "1", 0, "s", one("1"), None, "a"), ("b", "2", 1, "s", one("2"), "a", "a"), ("c", "10", 2, "s", one("10"), "a", "a")], schema)
    changes = diff.changelog(diff.first_changes(units), None)
    findings = spark.createDataFrame([("CHECKSUM", "warning")], "rule string, severity string")
    folder = f"{tmp_path}/r1"
    made = {r.name: r.lines for r in bundle.build(units, changes, findings, folder, "r1", "s").collect()}
    assert made == {"territories.ndjson": 3, "territories.csv": 3, "territory-identifiers.csv": 3, "changelog.json": 1, "contract.json": 13, "validation-report.json": 1}
    assert bundle.verified(spark, folder, "r1").count() == 3
    again = f"{tmp_path}/again"
    bundle.build(units.repartition(3), changes, findings, again, "r1", "s")
    digests = [sorted(map(tuple, spark.read.json(f"{f}/manifest.json").collect())) for f in (folder, again)]
    assert digests[0] == digests[1]
    with pytest.raises(ValueError, match="another"):
        bundle.verified(spark, folder, "r2")
    part = next(p for p in (tmp_path / "r1" / "territories.ndjson").iterdir() if p.name.startswith("part") and p.stat().st_size)
    part.write_text(part.read_text().replace('"b"', '"x"'))
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError, match="sums"):
        bundle.verified(spark, folder)
    for bad, rows in ((units.where("code != '1'"), findings), (units, spark.createDataFrame([("X", "blocker")], "rule string, severity string")), (units.limit(0), findings)):
        with pytest.raises(ValueError):
            bundle.build(bad, changes, rows, f"{tmp_path}/bad", "r1", "s")
    assert not (tmp_path / "bad").exists()
    names = [r.name for r in bundle.contract(spark).collect()]
    offered = spark.createDataFrame([("a", "1.2.0", names), ("b", "2.0.0", names), ("c", "1.0", names), ("d", "1.0.0", names[1:]), ("e", "1.0.0", names + names), ("f", "1.0.0", None)], "contract string, version string, names array<string>")
    assert [r.verdict for r in bundle.compatibility(offered).orderBy("contract").collect()] == ["compatible", "MAJOR_DIFFERS", "VERSION_INVALID", "ARTIFACT_MISSING", "ARTIFACTS_REPEATED", "ARTIFACTS_REPEATED"]


def test_order_across_gaps_and_identifiers_in_time(spark):
    from grovespark.operators import governance

    units = spark.createDataFrame([("a", "5", 0), ("b", "3", 2), ("c", "7", 9), ("d", "x", 10), ("e", "9", 30)], "territory_id string, code string, position long")
    assert [r.territory_id for r in governance.out_of_order(units).collect()] == ["b"]
    assert governance.out_of_order(units.limit(0)).count() == 0
    held = [("a", "1", 0, "s", [("k", "v", "2001")]), ("b", "2", 1, "s", [("k", "v", "2002")]), ("c", "3", 2, "s", [("k", "v", "2002")])]
    schema = "territory_id string, code string, position long, snapshot string, identifiers array<struct<scheme:string,value:string,valid_from:string>>, parent_id string, county_id string"
    found = governance.candidate_faults(spark.createDataFrame([(*r, None, None) for r in held], schema), "s").where("fault = 'IDENTIFIER_REPEATED'").collect()
    assert [r.territory_id for r in found] == ["b"]


def test_siblings_without_code(spark):
    from grovespark.operators import graph

    units = spark.createDataFrame([("u1", None, "Same", None), ("u2", None, "Same", None), ("u3", "9", "Same", None)], "territory_id string, code string, official_name string, parent_id string")
    assert {r.territory_id: r.slug for r in graph.slugs(units).collect()} == {"u1": "same", "u2": "same-u2", "u3": "same-9"}


def test_rings_of_repeated_units(spark):
    """Of a repeated unit the parent at the first position counts, in whatever order rows are read; a unit that is its own parent is a ring."""
    rows = [("a", "1", 0, "b"), ("b", "2", 1, "a"), ("a", "3", 2, "gone"), ("s", "4", 3, "s"), ("d", "5", 4, "gone"), ("e", "6", 5, "d"), ("d", "7", 6, "e")]
    schema = "territory_id string, code string, position long, snapshot string, identifiers array<struct<scheme:string,value:string>>, parent_id string, county_id string"
    for some in (rows, rows[::-1]):
        units = spark.createDataFrame([(i, code, at, "s1", [], parent, None) for i, code, at, parent in some], schema).coalesce(1)
        found = governance.candidate_faults(units, "s1").where("fault = 'HIERARCHY_CYCLE'").collect()
        assert sorted(r.territory_id for r in found) == ["a", "s"]


def test_depth_of_merkle_tree(spark, sf, monkeypatch):
    """A tree ends at the deepest level that is asked for, with every line; the query's at the fourth, as its SQL, however many lines there are."""
    from grovespark.plans import catalogue

    lines = spark.range(3000).select(F.col("id").cast("string").alias("line"))
    levels = lambda df: {r.level: r.lines for r in df.groupBy("level").agg(F.sum("lines").alias("lines")).collect()}
    assert levels(merkle.tree(lines, 1, deepest=2)) == dict.fromkeys(range(3), 3000) and levels(merkle.tree(lines, 1)) == dict.fromkeys(range(4), 3000)
    tree = merkle.tree
    monkeypatch.setattr(merkle, "tree", lambda lines, most, **options: tree(lines, most / 2**16, **options))  # 1,500 lines would make six levels
    assert levels(catalogue.queries()["merkle_tree"](spark, sf)) == dict.fromkeys(range(5), 1500)


def test_conflicts_in_blocks(spark, monkeypatch):
    """All conflicts, in any number of blocks and tasks: of identifiers that many units have, and few, and one side only; repeated rows as often as a plain join has them."""
    rng = random.Random(3)
    rows = lambda n, units: [("s", rng.choice(["hot", "hot", "hot", str(rng.randrange(9)), None]), f"t{rng.randrange(units)}") for _ in range(n)]
    wanted, known = rows(300, 90) + [("s", "one", "t1"), ("s", "hot", None)], rows(200, 90) + [("s", "other", "t1"), ("z", "one", "t2")]
    want = sorted((s, v, t, o) for s, v, t in wanted for z, x, o in known if (s, v) == (z, x) and v is not None and t is not None and o != t)
    frames = [spark.createDataFrame(r, "scheme string, value string, territory_id string").coalesce(1) for r in (wanted, known)]
    for block, pairs in ((7, 500), (1_000, 8_000_000)):
        monkeypatch.setattr(history, "BLOCK_ROWS", block)
        monkeypatch.setattr(history, "TASK_PAIRS", pairs)
        assert sorted(map(tuple, history.identifier_conflicts(*frames).collect())) == want
    assert history.identifier_conflicts(frames[0].limit(0), frames[1]).count() == 0


def test_conflicts_of_one_identifier_are_spread(spark, monkeypatch):
    """The pairs of a single identifier are made in many tasks, none with more than a few times its share."""
    monkeypatch.setattr(history, "BLOCK_ROWS", 20, raising=False)
    monkeypatch.setattr(history, "TASK_PAIRS", 5_000, raising=False)
    units = spark.range(400).select(F.lit("s").alias("scheme"), F.lit("v").alias("value"), F.concat(F.lit("t"), "id").alias("territory_id"))
    sizes = [r.n for r in history.identifier_conflicts(units, units).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 400 * 399 and len(sizes) > 20 and max(sizes) < 25_000
