"""Manifests line by line: written from fragments, read as plain JSON readers would read them."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from provtally import fixtures as fx
from provtally.plans import manifests as mf
from provtally.plans import release as rl
from provtally.queries import SETTINGS

AT = rl.manifest_path(SETTINGS.release_id)


def _digest(n):
    return "sha256:" + hashlib.sha256(str(n).encode()).hexdigest()


ODD = {"a,b.json": _digest(1), 'q"uo\\te.json': _digest(2), "é \n.json": _digest(3), "{}": _digest(4), '"artifactDigests":{': _digest(5)}


def _publish(spark, root, listed):
    rows = spark.createDataFrame(list(listed.items()), "path string, digest string")
    return rl.publish_listing(rows, fx.catalog(), SETTINGS, str(root))


def _listed(found):
    return {r["path"]: r["digest"] for r in found.listed.collect()}


@pytest.mark.parametrize("listed", [{}, {"one.json": _digest(0)}, ODD], ids=["none", "one", "odd"])
def test_round_trip(spark, tmp_path, listed):
    digest = _publish(spark, tmp_path, listed)
    raw = (tmp_path / AT).read_bytes()
    assert digest == "sha256:" + hashlib.sha256(raw).hexdigest()
    document = json.loads(raw)
    assert document["artifactDigests"] == listed and list(document["artifactDigests"]) == sorted(listed, key=lambda p: p.encode())
    assert json.loads((tmp_path / rl.POINTER_PATH).read_text())["manifestDigest"] == digest
    found = mf.read_manifest(spark, str(tmp_path), AT)
    assert (found.digest, found.is_json, found.message) == (digest, True, None)
    assert _listed(found) == listed and found.value("releaseId") == SETTINGS.release_id
    assert {r["path"] for r in found.paths().collect()} == {f.path for f in fx.catalog().filters}


def test_same_as_read_whole(spark, tmp_path, monkeypatch):
    _publish(spark, tmp_path, ODD)
    text = (tmp_path / AT).read_text()
    first = text.split("\n")[1]
    changed = {
        "indented": json.dumps(json.loads(text), indent=1), "one line": json.dumps(json.loads(text)), "crlf": text.replace("\n", "\r\n"),
        "mark": "﻿" + text, "last break": text + "\n", "broken entry": text.replace(first, first[:-1]),
        "no comma": text.replace("\n,", "\n", 1), "comma first": text.replace("{\n", "{\n,", 1), "rest": text + "x", "cut": text[:-2],
        "bad digest": text.replace(_digest(3), "sha256:x"), "no text": text.replace(f'"{_digest(4)}"', "5"), "no path": text.replace('"{}"', '""'),
        "unknown key": text[:-1] + ',"extra":1}', "bad release": text.replace('"releaseId":"fixture-1"', '"releaseId":""'),
        "bad both": text.replace(_digest(3), "x").replace('"releaseId":"fixture-1"', '"releaseId":""'),
        "bad after": text.replace(_digest(3), "x").replace('"methodologyVersion":"1.0.0"', '"methodologyVersion":1'),
        "two pairs": text.replace("\n,", f'\n,"x":"{_digest(7)}","y":"{_digest(8)}",', 1).replace(",,", ","), "blank line": text.replace("\n,", "\n\n,", 1),
        "last counts": text.replace("\n}", f'\n,"{{}}":"{_digest(9)}"\n}}'), "closed early": text.replace("\n,", "\n},", 1), "list": "[]",
    }
    by_line, read = [], mf._by_line

    def spied(*args):
        by_line.append(read(*args))
        return by_line[-1]

    monkeypatch.setattr(mf, "_by_line", spied)
    for name, body in changed.items():
        (tmp_path / AT).write_bytes(body.encode())
        digest = "sha256:" + hashlib.sha256(body.encode()).hexdigest()
        found, whole = mf.read_manifest(spark, str(tmp_path), AT), mf._whole(spark, str(tmp_path), AT, digest)
        assert (found.digest, found.is_json, found.message) == (digest, whole.is_json, whole.message), name
        if whole.is_json:
            assert _listed(found) == _listed(whole), name
            if whole.message is None:
                assert _listed(found) == json.loads(body.removeprefix("﻿"))["artifactDigests"], name
    assert sum(m is not None for m in by_line) >= 8


def test_absent(spark, tmp_path):
    (tmp_path / "other").write_text("x")
    assert mf.read_manifest(spark, str(tmp_path), AT) is None
    (tmp_path / "empty").write_text("")
    assert mf.read_manifest(spark, str(tmp_path), "empty") is None


def test_paths_listed_twice_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([("a", _digest(1)), ("a", _digest(2))], "path string, digest string")
    with pytest.raises(ValueError, match="more than once: a"):
        rl.publish_listing(rows, fx.catalog(), SETTINGS, str(tmp_path))
    assert not (tmp_path / rl.POINTER_PATH).exists()


def test_many_entries_over_splits(spark, tmp_path):
    n = 60_000
    path = F.concat(F.lit("releases/r/creators/US/displayNameAsc/page-"), F.col("id"), F.lit(".json"))
    rows = spark.range(n).select(path.alias("path"), F.concat(F.lit("sha256:"), F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    digest = rl.publish_listing(rows, fx.catalog(), SETTINGS, str(tmp_path))
    raw = (tmp_path / AT).read_bytes()
    assert digest == "sha256:" + hashlib.sha256(raw).hexdigest()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700000")
    try:
        found = mf._by_line(spark, str(tmp_path), AT, digest)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found is not None and found.is_json and found.message is None
    assert found.listed.join(rows, ["path", "digest"]).count() == n == found.listed.count()
