"""A written release: its documents, its audit, and one fault at a time."""

import hashlib
import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from provtally import fixtures as fx
from provtally.operators import metrics as mt
from provtally.plans import audit as au
from provtally.plans import explore as ex
from provtally.plans import release as rl
from provtally.queries import SETTINGS
from provtally.sources import contracts as ct
from provtally.sources.artifacts import digest_file, read_artifacts, write_artifacts
from provtally.sources.boundaries import read_boundaries

BASE = f"releases/{fx.RELEASE_ID}"


@pytest.fixture(scope="module")
def release(spark, sf, tmp_path_factory):
    root = tmp_path_factory.mktemp("release") / "out"
    inputs = rl.Inputs(
        fx.observations(spark, sf), fx.resolutions(spark, sf), fx.channels(spark, sf), fx.removals(spark, sf),
        fx.catalog(),
    )
    rl.build_release(inputs, SETTINGS, str(root))
    return root


def _load(root, path):
    return json.loads((root / path).read_text())


def test_documents_hang_together(release):
    pointer = _load(release, rl.POINTER_PATH)
    manifest = _load(release, pointer["manifestPath"])
    for path, digest in manifest["artifactDigests"].items():
        assert digest == "sha256:" + hashlib.sha256((release / path).read_bytes()).hexdigest()
    written = {str(p.relative_to(release)) for p in release.rglob("*.json")}
    assert written == {*manifest["artifactDigests"], rl.POINTER_PATH, pointer["manifestPath"]}
    assert not list(release.rglob(".[0-9a-f]*"))
    overview = _load(release, f"{BASE}/overview.json")
    assert sum(overview["coverage"]["partition"].values()) == overview["representedVideoCount"]
    listed = 0
    for row in overview["countries"]:
        shard = _load(release, f"{BASE}/countries/{row['country']}.json")
        assert shard["creatorCount"] == row["creatorCount"]
        for order, paths in shard["pageIndex"].items():
            pages = [_load(release, p) for p in paths]
            assert [p["nextCursor"] for p in pages] == [str(i + 1) for i in range(len(pages) - 1)] + [None] * bool(pages)
            rows = [r for p in pages for r in p["rows"]]
            assert len(rows) == shard["firstPage"]["totalRows"]
            assert len({r["publicChannelKey"] for r in rows}) == len(rows)
            names = [r["displayName"] for r in rows]
            counts = [r["representedVideoCount"] for r in rows]
            assert names == sorted(names) if order == "displayNameAsc" else counts == sorted(counts, reverse=True)
        if shard["pageIndex"]["representedVideoCountDesc"]:
            assert shard["firstPage"] == _load(release, shard["pageIndex"]["representedVideoCountDesc"][0])
        listed += shard["firstPage"]["totalRows"]
    assert listed > 0


def test_sound_release_passes(spark, release):
    rows = au.audit_release(spark, str(release)).collect()
    assert {r["status"] for r in rows} == {"ok"}
    assert len(rows) == len(list(release.rglob("*.json")))


def _copy(release, tmp_path):
    target = tmp_path / "copy"
    shutil.copytree(release, target)
    return target


def _redigest(root, path, body=None):
    """Put a body in place and make manifest and pointer agree with it."""
    if body is not None:
        (root / path).write_text(body)
    pointer = _load(root, rl.POINTER_PATH)
    manifest = _load(root, pointer["manifestPath"])
    if path != pointer["manifestPath"]:
        manifest["artifactDigests"][path] = "sha256:" + hashlib.sha256((root / path).read_bytes()).hexdigest()
        (root / pointer["manifestPath"]).write_text(json.dumps(manifest))
    raw = (root / pointer["manifestPath"]).read_bytes()
    pointer["manifestDigest"] = "sha256:" + hashlib.sha256(raw).hexdigest()
    (root / rl.POINTER_PATH).write_text(json.dumps(pointer))


def _faults(spark, root):
    return {r["path"]: (r["status"], r["detail"]) for r in au.audit_release(spark, str(root)).collect()
            if r["status"] != "ok"}


def _edit(path, change):
    def apply(root):
        doc = _load(root, path)
        change(doc)
        _redigest(root, path, json.dumps(doc))
    return apply


SHARD = f"{BASE}/countries/US.json"
PAGE = f"{BASE}/creators/US/displayNameAsc/page-0.json"
OVERVIEW = f"{BASE}/filters/candidate.json"


def _flip(root):
    raw = bytearray((root / PAGE).read_bytes())
    raw[-2] ^= 1
    (root / PAGE).write_bytes(bytes(raw))


def _unlist(root):
    pointer = _load(root, rl.POINTER_PATH)
    manifest = _load(root, pointer["manifestPath"])
    del manifest["artifactDigests"][PAGE]
    (root / pointer["manifestPath"]).write_text(json.dumps(manifest))
    _redigest(root, pointer["manifestPath"])


def _unlist_and_drop(root):
    _unlist(root)
    (root / PAGE).unlink()


def _set(key, value):
    return lambda d: d.__setitem__(key, value)


CASES = {
    "byte flipped": (_flip, PAGE, "digest-mismatch"),
    "file dropped": (lambda root: (root / PAGE).unlink(), PAGE, "not-found"),
    "not listed": (_unlist, PAGE, "not-found"),
    "neither listed nor there": (_unlist_and_drop, PAGE, "not-found"),
    "not JSON": (lambda root: _redigest(root, PAGE, "{"), PAGE, "schema-invalid"),
    "extra key": (_edit(SHARD, _set("note", 1)), SHARD, "schema-invalid"),
    "bad country": (_edit(PAGE, lambda d: d["rows"][0].__setitem__("country", "us")), PAGE, "schema-invalid"),
    "broken sum": (
        _edit(OVERVIEW, lambda d: d["coverage"]["partition"].__setitem__("invalid", 10**6)), OVERVIEW, "schema-invalid"
    ),
    "foreign overview": (_edit(OVERVIEW, _set("releaseId", "other")), OVERVIEW, "mixed-release"),
    "foreign shard": (_edit(SHARD, _set("country", "DE")), SHARD, "mixed-release"),
    "altered totals": (_edit(SHARD, lambda d: d.__setitem__("creatorCount", d["creatorCount"] + 1)), SHARD, "mixed-release"),
    "foreign page": (_edit(PAGE, _set("sortOrder", "representedVideoCountDesc")), PAGE, "mixed-release"),
}


@pytest.mark.parametrize("case", CASES)
def test_one_fault_gives_one_status(spark, release, tmp_path, case):
    mutate, path, status = CASES[case]
    root = _copy(release, tmp_path)
    mutate(root)
    faults = _faults(spark, root)
    assert set(faults) == {path}
    assert faults[path][0] == status


def test_a_page_below_a_broken_shard_is_held_to_its_path(spark, release, tmp_path):
    root = _copy(release, tmp_path)
    _edit(SHARD, _set("note", 1))(root)
    _edit(PAGE, _set("country", "QQ"))(root)
    faults = _faults(spark, root)
    assert {p: f[0] for p, f in faults.items()} == {SHARD: "schema-invalid", PAGE: "mixed-release"}
    assert faults[PAGE][1] == au.OTHER_PAGE


def test_pointer_and_manifest_faults(spark, release, tmp_path):
    root = _copy(release, tmp_path)
    whole = (root / rl.POINTER_PATH).read_text()
    manifest_at = json.loads(whole)["manifestPath"]

    def only():
        rows = au.audit_release(spark, str(root)).collect()
        return [(r["kind"], r["status"]) for r in rows]

    (root / rl.POINTER_PATH).write_text("{")
    assert only() == [("pointer", "pointer-refresh")]
    (root / rl.POINTER_PATH).write_text(whole.replace('"schemaVersion":"1.0.0"', '"schemaVersion":"2.0.0"'))
    assert only() == [("pointer", "pointer-refresh")]
    (root / rl.POINTER_PATH).write_text(whole.replace(f'"releaseId":"{fx.RELEASE_ID}"', '"releaseId":"x"'))
    assert only() == [("pointer", "ok"), ("manifest", "mixed-release")]
    (root / rl.POINTER_PATH).write_text(whole)
    body = (root / manifest_at).read_text()
    (root / manifest_at).write_text(body + " ")
    assert only() == [("pointer", "ok"), ("manifest", "digest-mismatch")]
    (root / manifest_at).unlink()
    assert only() == [("pointer", "ok"), ("manifest", "not-found")]
    (root / rl.POINTER_PATH).unlink()
    assert only() == [("pointer", "not-found")]


def test_issue_messages(spark):
    manifest = {
        "schemaVersion": "1.0.1", "releaseId": "", "generatedAt": "2023-02-29T00:00:00Z", "enrichmentCutoff": 5,
        "defaultFilter": None, "datasets": [], "artifactDigests": {"": "x"}, "methodologyVersion": True,
        "disclosurePolicyVersion": "1", "boundaryMetadata": {}, "filters": [{"isDefault": "no"}], "zz": 1,
    }
    df = spark.createDataFrame([(1, json.dumps(manifest)), (2, "nope")], "id long, body string")
    rows = au.document_issues(df, ct.MANIFEST, "id").collect()
    got = [(r["path"], r["message"]) for r in rows if r["id"] == 1]
    assert got[:8] == [
        ("schemaVersion", 'Invalid literal value, expected "1.0.0"'),
        ("releaseId", "String must contain at least 1 character(s)"),
        ("generatedAt", "Invalid datetime"),
        ("enrichmentCutoff", "Expected string, received number"),
        ("defaultFilter", "Expected object, received null"),
        ("datasets", "Array must contain at least 1 element(s)"),
        ("artifactDigests.", "String must contain at least 1 character(s)"),
        ("artifactDigests.", ct.DIGEST_MESSAGE),
    ]
    assert ("boundaryMetadata.license", "Required") in got
    assert ("filters.0.isDefault", "Expected boolean, received string") in got
    assert got[-1] == ("", "Unrecognized key(s) in object: 'zz'")
    assert [(r["path"], r["message"]) for r in rows if r["id"] == 2] == [("", "not JSON")]


def test_one_json_value_and_nothing_else(spark):
    from pyspark.sql import functions as F

    good = ['{"a":1,"a":2}', " {} ", '"x"', "[1]", "3"]
    bad = ["{} x", "{}{}", "{},{}", "{}}", "{}],[{}", '{},"value":{}', "", "{'a':1}", "[1,]", '{"a":01}', "nope"]
    df = spark.createDataFrame([(t, True) for t in good] + [(t, False) for t in bad], "t string, ok boolean")
    df = df.withColumn("v", au.parsed_text(F.col("t")))
    assert df.where(F.col("v").isNotNull() != F.col("ok")).count() == 0
    assert df.where("t like '%\"a\":2%'").select(F.to_json("v")).first()[0] == '{"a":2}'


def test_numbers_of_any_size(spark):
    partition = {s: 0 for s in ct.PARTITION_STATES}
    texts = {"1e20": [], "1.0": [], "1.5": ["Expected integer, received float"], "-1": ["Number must be greater than or equal to 0"],
             "1e400": ["Expected integer, received float"], '"1"': ["Expected number, received string"]}
    rows = [(n, json.dumps({**partition, "invalid": 0}).replace('"invalid": 0', f'"invalid": {n}')) for n in texts]
    found = au.document_issues(spark.createDataFrame(rows, "id string, body string"), ct.PARTITION, "id").collect()
    for n, messages in texts.items():
        assert [r["message"] for r in found if r["id"] == n] == messages, n


def test_artifacts_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([("a/b.json", '{"x":"é"}'), ("c.json", "{}")], "path string, body string")
    assert write_artifacts(docs, str(tmp_path / "r")) == 2
    assert write_artifacts(docs, str(tmp_path / "r")) == 2
    got = {r["path"]: bytes(r["content"]).decode() for r in read_artifacts(spark, str(tmp_path / "r")).collect()}
    assert got == {"a/b.json": '{"x":"é"}', "c.json": "{}"}
    assert read_artifacts(spark, str(tmp_path / "r"), "a/*").count() == 1
    assert read_artifacts(spark, str(tmp_path / "r"), "z/*").count() == 0


def test_roots_by_scheme_and_with_blanks(spark, tmp_path):
    docs = spark.createDataFrame([("a/b c.json", "{}")], "path string, body string")
    for root in (f"file://{tmp_path}/one", f"file:{tmp_path}/two", f"{tmp_path}/th ree/"):
        assert write_artifacts(docs, root) == 1
        assert [r["path"] for r in read_artifacts(spark, root).collect()] == ["a/b c.json"]
        assert digest_file(spark, root, "a/b c.json") == "sha256:" + hashlib.sha256(b"{}").hexdigest()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["one", "th ree", "two"]


def test_boundary_file(spark, tmp_path):
    doc = {"type": "FeatureCollection", "metadata": {"datasetName": "n"}, "features": [
        {"type": "Feature", "properties": {"iso": "DE", "name": "Germany"}, "geometry": {"type": "Point"}},
        {"type": "Feature", "properties": {"name": "Nowhere"}}]}
    (Path(tmp_path) / "b.json").write_text(json.dumps(doc, indent=1))
    got = [tuple(r) for r in read_boundaries(spark, str(tmp_path / "b.json")).collect()]
    assert got == [("DE", "Germany"), (None, "Nowhere")]


def test_a_country_beyond_one_shard_is_refused(spark, monkeypatch):
    counts = spark.createDataFrame([("DE", "a", 3), ("DE", "b", 3), ("FR", "a", 5)], "country string, sort_order string, page_count long")
    monkeypatch.setattr(rl, "MAX_SHARD_PAGES", 6)
    rl._refuse_beyond_shard(counts)
    monkeypatch.setattr(rl, "MAX_SHARD_PAGES", 5)
    with pytest.raises(ValueError, match="larger page size"):
        rl._refuse_beyond_shard(counts)


def test_exploring_a_release(spark, release):
    opened = ex.open_release(spark, str(release))
    assert opened.release_id == fx.RELEASE_ID and len(opened.catalog.filters) == 9
    overview, exact = opened.overview()
    assert exact and overview.first()["creatorCount"] == _load(release, f"{BASE}/overview.json")["creatorCount"]
    narrow, exact = opened.overview(["ds-af"], ["Candidate"])
    assert exact and narrow.first()["representedVideoCount"] < overview.first()["representedVideoCount"]
    assert opened.overview(["ds-af", "ds-nf"])[1] is False
    assert opened.country_rows().count() == len(_load(release, f"{BASE}/overview.json")["countries"])
    assert opened.shard("US").first()["country"] == "US"
    assert opened.shard("QQ").count() == 0
    with pytest.raises(ex.ArtifactError, match="disagrees with the overview"):
        opened.shard("US", ["ds-af"])
    page = opened.page("US", "displayNameAsc", 0).first()
    assert page["totalRows"] == len(page["rows"]) or page["nextCursor"] == "1"
    with pytest.raises(ex.ArtifactError, match="does not exist; this country has"):
        opened.page("US", "displayNameAsc", 99)
    with pytest.raises(ex.ArtifactError, match="publishes no pages for the newest order"):
        opened.page("US", "newest", 0)


def test_exploring_refuses_damaged_documents(spark, release, tmp_path):
    root = _copy(release, tmp_path)
    opened = ex.open_release(spark, str(root))
    _flip(root)
    with pytest.raises(ex.ArtifactError) as caught:
        opened.page("US", "displayNameAsc", 0)
    assert caught.value.kind == "digest-mismatch"
    (root / rl.POINTER_PATH).write_text("{}")
    with pytest.raises(ex.ArtifactError) as caught:
        ex.open_release(spark, str(root))
    assert caught.value.kind == "pointer-refresh"


def test_stored_pages_are_pruned(spark, sf, tmp_path):
    from provtally.operators import creators as cr
    from provtally.queries import _listing

    pages = rl.page_rows(cr.paged(_listing(spark, sf), 5), 5)
    path = str(tmp_path / "pages")
    rl.store_pages(pages, path)
    page = rl.stored_page(spark, path, "US", cr.BY_NAME, 0)
    names = [r["displayName"] for r in page.orderBy("position").collect()]
    assert names and names == sorted(names)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country" in plan and "EqualTo(page,0)" in plan


def _requests(spark, rows):
    schema = "request_id long, country string, sort_order string, page long"
    return spark.createDataFrame(rows, schema)


def test_requests_read_only_the_folders_they_ask_for(spark, sf, tmp_path):
    from provtally.operators import creators as cr
    from provtally.queries import _listing

    listing = rl.kept(_listing(spark, sf), "listing")
    counts = rl.kept(cr.page_counts(listing, 5), "counts")
    pages = rl.kept(rl.page_rows(cr.paged(listing, 5), 5), "pages")
    path = tmp_path / "pages"
    rl.store_pages(pages, str(path))
    asked = [(1, "US", cr.BY_NAME, 0), (2, "US", cr.BY_NAME, 0), (3, "US", cr.BY_NAME, -1), (4, "US", "newest", 0),
             (5, "QQ", cr.BY_NAME, 0), (6, "US", cr.BY_NAME, None), (7, None, None, 0)]
    content = rl.page_content(_requests(spark, asked), counts, str(path), fx.RELEASE_ID)
    assert "dynamicpruning" in content._jdf.queryExecution().executedPlan().toString()
    # From here on, whoever opens another folder fails.
    for folder in path.glob("country=*/sort_order=*"):
        if folder.parent.name != "country=US" or folder.name != f"sort_order={cr.BY_NAME}":
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"spoilt")
                (folder / f".{file.name}.crc").unlink(missing_ok=True)
    rows = content.collect()
    want = pages.where(f"country = 'US' and sort_order = '{cr.BY_NAME}' and page = 0").first()["document"]
    for request in (1, 2):
        got = sorted((r for r in rows if r["request_id"] == request), key=lambda r: r["position"])
        assert [r["publicChannelKey"] for r in got] == [r["publicChannelKey"] for r in want["rows"]]
        assert {(r["status"], r["next_cursor"], r["total_rows"]) for r in got} == {("ok", want["nextCursor"], want["totalRows"])}
    others = [r for r in rows if r["request_id"] > 2]
    assert sorted(r["request_id"] for r in others) == [3, 4, 5, 6, 7]
    assert {(r["status"], r["publicChannelKey"], r["position"]) for r in others} == {("not-found", None, None)}


def test_requests_for_nothing(spark, sf, tmp_path):
    from provtally.operators import creators as cr
    from provtally.queries import _listing

    listing = rl.kept(_listing(spark, sf), "listing")
    path = str(tmp_path / "pages")
    rl.store_pages(rl.page_rows(cr.paged(listing, 5), 5), path)
    counts = cr.page_counts(listing, 5)
    assert rl.page_content(_requests(spark, []), counts, path, fx.RELEASE_ID).count() == 0
    assert [r["status"] for r in rl.page_content(_requests(spark, [(1, "QQ", cr.BY_NAME, 0)]), counts, path, fx.RELEASE_ID).collect()] == ["not-found"]


_CHANNEL = "UC" + "abcdefghijk" * 2


def _leak_tables(spark):
    bodies = [
        ("a.json", f'{{"name":"{_CHANNEL} and V0000000001","more":"V0000000001"}}'),
        ("b.json", '{"name":"xV0000000001 V0000000001x V0000000009"}'),
        ("c.json", ""), ("d.json", None),
    ]
    documents = spark.createDataFrame(bodies, "path string, body string")
    ids = [("V0000000001",), ("V0000000001",), ("V0000000002",), (_CHANNEL,), ("name",), (None,)]
    return documents, spark.createDataFrame(ids, "token string")


def test_raw_identifiers_are_found_where_they_stand_free(spark):
    found = rl.release_leaks(*_leak_tables(spark)).collect()
    assert {tuple(r) for r in found} == {("video", "V0000000001", "a.json", 2), ("channel", _CHANNEL, "a.json", 1)}
    documents, raw = _leak_tables(spark)
    assert rl.release_leaks(documents, raw.limit(0)).count() == 0
    assert rl.release_leaks(documents.limit(0), raw).count() == 0


def test_many_raw_identifiers_are_thinned_by_a_bloom_filter(spark, tmp_path):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    documents, raw = _leak_tables(spark)
    raw.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    words = rl.kept(documents.select(F.explode(F.split("body", " ")).alias("token")).distinct(), "words")
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = raw.join(words.where("length(token) >= 11"), "token").select("token").distinct()
        assert "might_contain" in joined._jdf.queryExecution().optimizedPlan().toString()
        assert rl.release_leaks(documents, raw).count() == 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_release_with_raw_identifiers_is_not_published(spark, tmp_path):
    documents, raw = _leak_tables(spark)
    documents = rl.with_digest(documents.where("path <> 'd.json'"))
    with pytest.raises(ValueError, match="raw identifiers in a.json"):
        rl.publish(documents, fx.catalog(), SETTINGS, str(tmp_path / "out"), raw)
    assert not list(tmp_path.rglob("*.json"))
    rl.publish(documents, fx.catalog(), SETTINGS, str(tmp_path / "out"), raw.where("token = 'V0000000002'"))
    assert (tmp_path / "out" / rl.POINTER_PATH).exists()


def _walked(spark, contract, texts):
    """(cleared by types, issues of the full walk) of each text."""
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, body string")
    checked = frame.select("i", ct.sound(contract, "body").alias("sound"), au.parsed_text(F.col("body")).alias("v"))
    rows = checked.select("i", "sound", F.col("v").isNotNull().alias("json"), ct.issues(contract, "v").alias("issues")).collect()
    return [(r["sound"], r["json"] and not r["issues"]) for r in sorted(rows, key=lambda r: r["i"])]


def _spoilt(value, odd):
    """Copies of a document with one value replaced, left out or joined by another."""
    if isinstance(value, dict):
        for k in value:
            yield {a: b for a, b in value.items() if a != k}
            yield from ({**value, k: o} for o in odd)
            yield from ({**value, k: v} for v in _spoilt(value[k], odd))
        yield {**value, "extra": 1}
    if isinstance(value, list):
        yield []
        yield value + value
        for i, item in enumerate(value[:1]):
            yield from (value[:i] + [v] + value[i + 1 :] for v in _spoilt(item, odd))


@pytest.mark.parametrize("name", ["manifest", "overview", "shard", "page"])
def test_types_clear_only_what_the_walk_clears(spark, release, name):
    paths = {"manifest": f"{BASE}/manifest.json", "overview": f"{BASE}/overview.json",
             "shard": f"{BASE}/countries/US.json", "page": f"{BASE}/creators/US/displayNameAsc/page-0.json"}
    contract = {"manifest": ct.MANIFEST, "overview": ct.OVERVIEW, "shard": ct.COUNTRY_SHARD, "page": ct.CREATOR_PAGE}[name]
    # A manifest has its entries on lines of their own.
    text = (release / paths[name]).read_text().replace("\n", "")
    body = json.loads(text)
    for key in ("artifactDigests", "pageIndex"):
        if key in body:
            body[key] = dict(list(body[key].items())[:2])
    texts = [text, text + " ", " " + text, text + "{}", text[:-1], "", "null", "[]", text.replace(":", " :", 1), json.dumps(body)]
    odd = (None, "", "x", -1, 0, 1.5, 2**70, True, [], {}, [1], "2024-02-30T00:00:00Z")
    made = [json.dumps(d, separators=(",", ":"), ensure_ascii=False) for d in _spoilt(body, odd)]
    texts += made if len(made) < 1500 else made[:: len(made) // 1500 + 1]
    result = _walked(spark, contract, texts)
    assert result[0] == (True, True)
    assert not [t for t, (sound, fits) in zip(texts, result, strict=True) if sound and not fits]
    # Written the same way, a document without a fault is cleared, unless a number is out of a long's range.
    missed = [t for t, (sound, fits) in zip(texts[10:], result[10:], strict=True) if fits and not sound]
    assert all(str(2**70) in t or "1.5" in t or ".0" in t for t in missed)


def test_removals_may_cover_the_totals(spark, sf):
    from dataclasses import replace

    inputs = rl.Inputs(
        fx.observations(spark, sf), fx.resolutions(spark, sf), fx.channels(spark, sf), fx.removals(spark, sf),
        fx.catalog(),
    )
    default = fx.catalog().default.key
    plain = rl.release_tables(inputs, SETTINGS)
    covered = rl.release_tables(inputs, replace(SETTINGS, removals_cover_totals=True))
    total = {k: t.cells.where(f"filter_key = '{default}'").agg({"creators": "sum"}).first()[0]
             for k, t in (("plain", plain), ("covered", covered))}
    removed = plain.creators.join(inputs.removals, "channel_key", "left_semi").count()
    assert removed > 0 and total["covered"] == total["plain"] - removed
    assert covered.listing.count() == plain.listing.count()


def _states(tables, key):
    rows = tables.cells.where(f"filter_key = '{key}'").groupBy("state").agg({"videos": "sum"}).collect()
    return {r[0]: r[1] for r in rows}


def test_removals_take_only_resolved_videos_from_the_totals(spark, sf):
    from dataclasses import replace

    inputs = rl.Inputs(
        fx.observations(spark, sf), fx.resolutions(spark, sf), fx.channels(spark, sf), fx.removals(spark, sf),
        fx.catalog(),
    )
    key = fx.catalog().default.key
    plain = rl.release_tables(inputs, SETTINGS)
    covered = rl.release_tables(inputs, replace(SETTINGS, removals_cover_totals=True))
    removed = plain.creators.join(inputs.removals, "channel_key", "left_semi")
    gone = removed.agg({"represented_video_count": "sum"}).first()[0]
    want = _states(plain, key)
    want["resolved"] -= gone
    assert gone > 0 and _states(covered, key) == want


def test_breakdown_agrees_with_the_country_rows_where_metadata_is_missing(spark, sf):
    channels = fx.channels(spark, sf).where("channel_key % 3 <> 0")
    inputs = rl.Inputs(
        fx.observations(spark, sf), fx.resolutions(spark, sf), channels, fx.removals(spark, sf), fx.catalog()
    )
    tables = rl.release_tables(inputs, SETTINGS)
    key = fx.catalog().default.key
    unknown = tables.breakdown.where("country = 'XX'").agg({"represented_video_count": "max"}).first()[0]
    total = tables.cells.where(f"filter_key = '{key}' and country = 'XX'").agg({"videos": "sum"}).first()[0]
    assert 0 < unknown <= total
    default = inputs.catalog.default
    one = inputs.catalog.only(default.key).single_dataset_filters()
    cells = mt.filter_cells(inputs.observations, inputs.resolutions, channels, one)
    members = inputs.catalog.members(default)
    want = cells.where(F.col("filter_key").isin(members) & (F.col("state") == mt.RESOLVED)).select(
        "country", "filter_key", "videos"
    )
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, tables.breakdown.collect()))


def test_readings_after_the_cutoff_stay_out_of_the_release(spark, sf):
    channels = fx.channels(spark, sf)
    old = channels.selectExpr("channel_key", "timestamp'2020-01-01' as observed_at", "1L as observation_id",
                              "display_name", "country", "last_observed_at")
    late = old.selectExpr("channel_key", "timestamp'2999-01-01' as observed_at", "2L as observation_id",
                          "display_name", "'ZZ' as country", "last_observed_at")
    inputs = rl.Inputs(
        fx.observations(spark, sf), fx.resolutions(spark, sf), channels, fx.removals(spark, sf), fx.catalog()
    )
    from dataclasses import replace

    read = rl.release_tables(replace(inputs, readings=old.unionByName(late)), SETTINGS)
    plain = rl.release_tables(inputs, SETTINGS)
    assert sorted(map(tuple, read.cells.collect()), key=repr) == sorted(map(tuple, plain.cells.collect()), key=repr)


def test_a_cluster_needs_a_shared_folder():
    from provtally.session import require_local

    require_local("local[4]")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            require_local(master)


@pytest.mark.parametrize(
    ("cutoff", "generated", "late"),
    [
        ("2025-01-01T00:00:00+19:00", "2024-01-01T00:00:00Z", True),
        ("2024-01-01T00:00:00-23:59", "2024-01-01T23:59:00Z", False),
        ("2024-01-01T00:00:01-23:59", "2024-01-01T23:59:00Z", True),
        ("2024-01-02T00:00:00+23:59", "2024-01-01T00:01:00Z", False),
        ("2024-01-01T00:00:00.5Z", "2024-01-01T00:00:00Z", True),
    ],
)
def test_offsets_are_subtracted_as_minutes(spark, cutoff, generated, late):
    from provtally.sources.contracts import _instant

    table = spark.createDataFrame([(cutoff, generated)], "c string, g string")
    assert table.selectExpr(f"{_instant('c')} > {_instant('g')} as late").first()[0] is late


def test_documents_are_checked_where_they_are_dealt_to(spark, tmp_path):
    """Neither step of a check moves below a repartition, to the one task that reads a file of one row group."""
    from provtally.queries import _dealt

    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    dealt = _dealt(spark.read.parquet(str(tmp_path / "one"))).select("id", F.lit("{}").alias("body"))
    body = F.concat(F.lit('{"id":'), F.col("id").cast("string"), F.lit("}"))
    found = au.document_issues(dealt.withColumn("body", body), ct.PARTITION, "id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    above, below = plan[: plan.index("Exchange")], plan[plan.index("Exchange") :]
    assert "from_json" in above and "from_json" not in below
    assert found.count() == 600


def test_rows_are_dealt_however_many_splits_their_files_make(spark):
    from provtally.queries import _dealt

    many = spark.range(0, 100, 1, spark.sparkContext.defaultParallelism + 3)
    plan = _dealt(many)._jdf.queryExecution().executedPlan().toString()
    assert f"RoundRobinPartitioning({spark.sparkContext.defaultParallelism + 3})" in plan


def test_an_audit_reads_many_small_splits_in_one_task(spark):
    cores = spark.sparkContext.defaultParallelism
    parts = lambda n: au._gathered(spark.range(0, 10 * n, 1, n)).rdd.getNumPartitions()
    assert [parts(1), parts(cores), parts(2 * cores), parts(10 * cores)] == [1, cores, 2 * cores, 2 * cores]
    assert parts(64 * cores) == 64 * cores // au.SPLITS


def test_shards_are_reconciled_with_occurrences_counted_once(spark, sf, monkeypatch):
    from provtally import queries

    calls, counted = [], mt.channel_counts
    for module in (mt, rl):
        monkeypatch.setattr(module, "channel_counts", lambda *args: calls.append(1) or counted(*args))
    assert queries.QUERIES["shard_reconcile"](spark, sf).count() > 0 and len(calls) == 1
