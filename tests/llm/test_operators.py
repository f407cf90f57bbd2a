"""Each operator against a brute-force version on small tables with every odd case."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken

import public_tokenizers
from provtally.llm import (
    byte_bpe,
    exact_dedup,
    jaccard_join,
    language_id,
    mixing,
    quality_rules,
    repeats,
    sharding,
    substring_dedup,
    suffix_dedup,
    url_filter,
)
from provtally.llm.queries import RANKS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_the_library_and_decodes(docs, rows, reference):
    got = sorted((tuple(r) for r in byte_bpe.round_trip(docs, RANKS).collect()), key=repr)
    want = []
    for i, text, *_ in rows:
        ids = reference.encode_ordinary(text or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(text or "")))
    assert got == sorted(want, key=repr)


def test_ids_and_offsets_lead_back_to_the_text(docs, rows):
    encoded = byte_bpe.encode(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), RANKS)
    texts = {i: (t or "").encode() for i, t, *_ in rows}
    for r in encoded.collect():
        starts = [*r["offsets"], len(texts[r["doc_id"]])]
        assert starts == sorted(starts) and len(r["ids"]) == len(r["offsets"])
    assert {r["doc_id"]: bytes(r["data"]) for r in byte_bpe.decode(encoded, RANKS).collect()} == {
        i: t for i, t in texts.items() if i is not None
    }


def test_boundaries_on_random_signs(reference):
    rnd = np.random.default_rng(2)
    signs = list("astrevlmd''\u0020\u0020\n\t19.,?é\u00a0\u3000中🙂") + ["'s", "'re", "'ll", " 'd", "\r\n"]
    texts = ["".join(rnd.choice(signs, rnd.integers(0, 40))) for _ in range(3000)]
    own = byte_bpe.Codec(RANKS)
    assert list(own.encode(texts)) == [reference.encode_ordinary(t) for t in texts]


def test_permutation_is_one_and_inverts():
    for n in (1, 2, 3, 64, 65, 1000):
        p, x = sharding.Permutation(n, 3), np.arange(n)
        assert sorted(p.forward(x)) == list(range(n)) and (p.inverse(p.forward(x)) == x).all()
        shard, slot = p.place(x, 8)
        assert (p.row(shard, slot, 8) == x).all()


def test_shards_are_even_gapless_and_independent_of_partitions(docs, rows, empty):
    got = sharding.document_shards(docs).collect()
    again = sharding.document_shards(docs.repartition(2)).collect()
    key = lambda r: repr(tuple(r))
    assert sorted(got, key=key) == sorted(again, key=key)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert sharding.document_shards(empty).count() == 0


def test_languages_of_held_out_documents(spark, docs, rows, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.document_languages(table)
    held = got.where("held_out").join(table.select("doc_id", "lang"), "doc_id")
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count() > 0
    odd = language_id.document_languages(docs).collect()
    assert len(odd) == len(rows)
    blank = {i for i, t, *_ in rows if not any(c.isalpha() for c in t or "")}
    assert all((r["lang_pred"] == "und") == (r["doc_id"] in blank) and 0 <= r["score"] <= 1 for r in odd)
    assert language_id.document_languages(empty).count() == 0


def test_codewords_are_far_apart():
    for k in (2, 3, 4, 5, 6, 40):
        code = language_id.codewords(k)
        apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
        assert min(apart) * 2 >= code.shape[1] or k == 2


def _repeats(rows):
    first = {}
    for i, t, *_ in rows:
        w = words(t)
        for s in range(len(w) - 49):
            k = tuple(w[s : s + 50])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - 49):
            if i is not None and first[tuple(w[s : s + 50])] < i:
                gone[s : s + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), sha(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("find", [substring_dedup.substring_dedup, suffix_dedup.suffix_dedup])
@pytest.mark.parametrize("hot", [2000, 1])
def test_repeated_passages_equal_brute_force(find, hot, docs, rows, empty):
    got = find(docs, hot_places=hot)
    assert sorted((tuple(r)[:4] for r in got.collect()), key=repr) == _repeats(rows)
    assert all(sum(b - a for a, b in r["spans"]) == r["n_removed"] for r in got.select("spans", "n_removed").collect())
    assert find(empty).count() == 0


def _links(rows):
    sets = []
    for i, t, *_ in rows:
        w = words(t)
        sets.append((i, {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())))
    parent, links = list(range(len(sets))), Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (_, s) in enumerate(sets):
        for b in range(a):
            t = sets[b][1]
            if s and t and 5 * len(s & t) >= 4 * len(s | t):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            least[root(a)] = min(least.get(root(a), i), i)
    return sorted(((i, least.get(root(a)), links[a], len(s)) for a, (i, s) in enumerate(sets)), key=repr)


@pytest.mark.parametrize("find", [substring_dedup.substring_dedup, suffix_dedup.suffix_dedup])
def test_a_line_that_two_texts_repeat_is_hot(find, spark):
    line = "this very line comes again and again in one text "
    rows = [(1, line * 60 + "then ends"), (2, "it begins " + line * 50), (3, line * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert repeats.candidates(docs, "doc_id", "text", 50, 12, hot_places=20).hot
    assert not repeats.candidates(docs, "doc_id", "text", 50, 12, hot_places=1000).hot
    for hot_places in (20, 1000):
        got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in find(docs, hot_places=hot_places).collect()}
        assert got == {1: (602, 0), 2: (502, 500), 3: (40, 0)}


@pytest.mark.parametrize("node", [768, 3])
def test_near_duplicates_equal_brute_force(node, docs, rows, empty, monkeypatch):
    monkeypatch.setattr(jaccard_join, "NODE", node)
    assert sorted((tuple(r)[:4] for r in jaccard_join.near_duplicates(docs).collect()), key=repr) == _links(rows)
    assert jaccard_join.near_duplicates(empty).count() == 0


def test_large_groups_of_one_body_keep_their_links(spark, monkeypatch):
    # Each group is one trial of its own keys: all of its members share every shingle but the last.
    monkeypatch.setattr(jaccard_join, "NODE", 8)
    rnd, rows, groups, copies = np.random.default_rng(3), [], 500, 20
    for g in range(groups):
        body = " ".join(f"w{x}" for x in rnd.integers(0, 1 << 40, 50))
        rows += [(g * copies + c, f"{body} tail{c}") for c in range(copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = jaccard_join.near_duplicates(docs).collect()
    assert Counter((r["doc_id"] // copies * copies == r["class_id"], r["n_links"]) for r in got) == {(True, copies - 1): len(rows)}


# At the first three seeds the least root node has no child that two of the copies follow.
@pytest.mark.parametrize("seed", [121, 168, 283, 5])
def test_a_thousand_copies_that_differ_in_the_last_word(spark, seed):
    body = " ".join(f"w{x}" for x in range(60))
    docs = spark.createDataFrame([(i, f"{body} tail{i}") for i in range(1000)], "doc_id long, text string").repartition(8)
    got = jaccard_join.near_duplicates(docs, seed=seed).collect()
    assert {(r["class_id"], r["n_links"]) for r in got} == {(0, 999)}


def test_runs_make_up_for_what_splits_lose():
    # A pair follows Poisson many shared children at the root, and each of those is lost with the chance below.
    lost = 0.0
    for _ in range(jaccard_join.DEPTH):
        lost = np.exp(-jaccard_join.BRANCH_BELOW * (1 - lost))
    for recall in (0.5, 0.9, 0.999, 0.99999):
        assert np.exp(-jaccard_join._runs(recall) * jaccard_join.BRANCH_ROOT * (1 - lost)) <= 1 - recall


def test_copies_and_the_index_across_batches(spark, docs, rows, empty):
    from provtally.session import new_folder

    index = exact_dedup.DigestIndex(spark, new_folder(spark, "index"), buckets=4)
    got = exact_dedup.deduplicate(docs, index).collect()
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    for r in got:
        own = next(g for t, g in groups.items() if sha(t) == r["text_sha256"])
        assert r["group_size"] == len(own) and r["keep_id"] == max((x for x in own if x is not None), default=None)
    assert len(got) == len(rows) and sum(r["kept"] for r in got) == len(groups)
    # The same texts again are all known, under the ids of before; one new text is learnt.
    new = docs.limit(1).selectExpr("99999L as doc_id", "'a new text' as text")
    later = exact_dedup.deduplicate(docs.select("doc_id", "text").unionByName(new), index).collect()
    assert [r["doc_id"] for r in later if r["kept"]] == [99999]
    assert index.rows().count() == len(groups) + 1
    assert exact_dedup.document_duplicates(empty).count() == 0
    # A reopened index goes on from its files.
    spark.sql(f"DROP TABLE {index.table}")
    assert exact_dedup.DigestIndex(spark, index.path, buckets=4).rows().count() == len(groups) + 1


def test_mix_meets_capped_targets(docs, rows, empty):
    got = mixing.mixed_sizes(docs).collect()
    sizes = Counter()
    for _, t, _, s, *_ in rows:
        sizes[s] += len(words(t))
    targets = {r["source"]: r["target"] for r in got}
    assert len(got) == len(rows) and abs(sum(targets.values()) - sum(sizes.values())) < 1e-6
    level = max(targets[s] / w for s, w in zip(["a", "b", None], [1, 2, 3], strict=True))
    for s, w in zip(["a", "b", None], [1, 2, 3], strict=True):
        assert targets[s] == pytest.approx(min(3 * sizes[s], level * w))
    for r in got:
        rate = r["target"] / r["source_size"]
        assert r["taken"] == r["size"] * r["copies"] and int(rate) <= r["copies"] <= int(rate) + 1
    assert mixing.mix_documents(docs).columns == docs.columns
    assert mixing.mixed_sizes(empty).count() == 0 and mixing.mix_documents(empty).count() == 0


def test_source_without_words_takes_nothing(spark):
    table = spark.createDataFrame([(1, "", "a"), (2, None, "a"), (3, "w " * 8, "b")], "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["target"], r["taken"]) for r in mixing.mixed_sizes(table).collect()}
    assert got == {1: (0.0, 0), 2: (0.0, 0), 3: (8.0, 8)}


def _signals(text):
    w = words(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    marked = [False] * len(w)
    for i in range(len(w) - 4):
        if grams[tuple(w[i : i + 5])] > 1:
            marked[i : i + 5] = [True] * 5
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), sum(marked))


def test_quality_signals_equal_brute_force_and_the_cascade_its_rules(docs, rows, empty):
    got = quality_rules.judge(docs).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(((i, *_signals(t)) for i, t, *_ in rows), key=repr)
    for r in got:
        base = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == base and not (base and r["kept"]) and r["kept"] == (r["rejected_by"] is None)
    passed = quality_rules.passing(docs)
    assert passed.columns == docs.columns and passed.count() == sum(r["kept"] for r in got)
    assert quality_rules.judge(empty).count() == 0 and quality_rules.passing(empty).count() == 0
    assert quality_rules.ordered(docs) == quality_rules.ordered(docs.repartition(2))
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


URLS = [
    "http://Example.NET/en/1", "https://a.example.net/de/1", "http://x.example.com/de/5.html?q", "http://x.org/fr/", "http://x.org/en/2",
    "ftp://badexample.net", "no scheme", None, "", "://", "http://example.com?x", "http://example.com/de", "a://b://c/d", "http://org/fr/é\n",
]


def test_rules_of_urls_equal_brute_force(spark, empty):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS * 2)], "page_id long, url string, verdict string")
    labels = spark.createDataFrame([(1, True), (1, False), (None, True), (5, None)], "page_id long, good boolean")
    got = url_filter.url_verdicts(pages, labels, url_filter.QUERY_RULES).collect()
    assert len(got) == len(URLS) * 2
    for r in got:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", URLS[r["page_id"] % len(URLS)] or "")
        host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [
            (len(h + p), h + p, a)
            for a, h, p in url_filter.QUERY_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        _, rule, action = max(fits, default=(0, None, "allow"))
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, action)
    assert url_filter.url_verdicts(pages.limit(0), labels, url_filter.QUERY_RULES).count() == 0


def test_bad_templates_are_blocked_and_like_siblings_merged(spark):
    rows = [(i, f"http://h.example/{'spam' if i % 2 else 'news'}/{i}") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2 == 0) for i in range(100)], "page_id long, good boolean")
    got = url_filter.url_verdicts(pages, labels, [url_filter.UrlRule("block", "other.example")]).collect()
    assert {(r["template"], r["verdict"]) for r in got} == {("/spam/{n}", "block"), ("/news/{n}", "allow")}


def test_varying_segments_become_wildcards(spark):
    rows = [(i, f"http://h.example/user-{chr(97 + i % 26)}{chr(97 + i // 26)}/home") for i in range(260)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(1, True)], "page_id long, good boolean")
    got = url_filter.url_verdicts(pages, labels, url_filter.QUERY_RULES).select("template").distinct().collect()
    assert [r[0] for r in got] == ["/*/home"]


def test_segments_below_a_wildcard_become_wildcards(spark):
    urls = [f"http://h.example/user-{chr(97 + u)}{v}/slug-{chr(97 + s)}{u}x{v}" for u in range(26) for v in "abcd" for s in range(4)]
    deep = [f"http://h.example/one/{u}/two/{s}-{u}/end" for u in ("abcdefghijklmnopqrstuvwxyz") for s in "pq"]
    rows = list(enumerate([*urls, *deep, "http://alone.example/" + "a/" * 40, "http://bare.example"]))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(1, True)], "page_id long, good boolean")
    got = url_filter.url_verdicts(pages, labels, url_filter.QUERY_RULES).collect()
    templates = Counter((r["host"], r["template"]) for r in got)
    assert templates == {
        ("h.example", "/*/*"): len(urls), ("h.example", "/one/*/two/*/end"): len(deep),
        ("alone.example", "/" + "a/" * 40): 1, ("bare.example", ""): 1,
    }


def test_like_siblings_are_merged_at_every_level(spark):
    bad = [f"http://h.example/shop/{a}/{b}" for a in "abc" for b in "xyz"]
    good = [f"http://h.example/news/{a}/{b}" for a in "abc" for b in "xyz"]
    rows = list(enumerate((bad + good * 4) * 3))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, "/news/" in u) for i, u in rows if i % 2], "page_id long, good boolean")
    got = url_filter.url_verdicts(pages, labels, [url_filter.UrlRule("block", "other.example")]).collect()
    assert {(r["template"].split("/")[1], r["verdict"]) for r in got} == {("shop", "block"), ("news", "allow")}
    assert len({r["purity"] for r in got}) == 2


def test_rows_of_one_id_and_of_none_are_told_apart(spark):
    rnd = np.random.default_rng(6)
    texts = [" ".join(f"w{x}" for x in rnd.integers(0, 1 << 60, 60)) for _ in range(4)]
    rows = [(1, texts[0]), (2, texts[0] + " x"), (2, texts[1]), (None, texts[2]), (None, texts[2] + " y"), (None, texts[3]), (5, texts[3] + " z")]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {(r["doc_id"], r["text"]): (r["class_id"], r["n_links"], r["stays"]) for r in got.join(
        spark.createDataFrame(rows, "id long, text string").selectExpr("xxhash64(text) as text_hash", "text"), "text_hash").collect()}
    assert found[1, rows[0][1]][:2] == found[2, rows[1][1]][:2] == (1, 1) and found[2, rows[2][1]] == (2, 0, True)
    assert found[None, rows[3][1]][:2] == found[None, rows[4][1]][:2] == (None, 1)
    assert found[None, rows[5][1]][:2] == found[5, rows[6][1]][:2] == (5, 1)
    for pair in ((0, 1), (3, 4), (5, 6)):
        assert sum(found[rows[i]][2] for i in pair) == 1


def _compared(monkeypatch, spark, n, seed=0):
    """Pairs of sets that final nodes compare, and links found, for texts that share one line of ten words and nothing else."""
    rnd = np.random.default_rng(seed)
    line = " ".join(f"licence{x}" for x in range(10))
    rows = [(i, " ".join(f"w{x}" for x in rnd.integers(0, 1 << 60, 60)) + " " + line) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    nodes, final = [], jaccard_join._final_nodes

    def counted(*args):
        found = final(*args)
        nodes.extend(found.groupBy("node").count().collect())
        return found

    monkeypatch.setattr(jaccard_join, "_final_nodes", counted)
    links = jaccard_join.near_duplicates(docs).agg({"n_links": "sum"}).first()[0]
    monkeypatch.setattr(jaccard_join, "_final_nodes", final)
    return sum(r["count"] * (r["count"] - 1) // 2 for r in nodes), links


def test_texts_that_share_one_line_are_not_compared_in_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "NODE", 64)
    for n in (1500, 3000, 6000):
        pairs, links = _compared(monkeypatch, spark, n)
        assert pairs <= 70 * n and links == 0


def test_clusters_below_common_lines_keep_their_links(spark, monkeypatch):
    # Half of each text is the same in all of them; clusters of three differ in one word.
    monkeypatch.setattr(jaccard_join, "NODE", 32)
    rnd, rows = np.random.default_rng(8), []
    common = " ".join(f"common{x}" for x in range(60))
    for g in range(200):
        body = [f"w{x}" for x in rnd.integers(0, 1 << 60, 60)]
        for c in range(3):
            own = list(body)
            own[20 * c] = "changed"
            rows.append((3 * g + c, " ".join(own) + " " + common))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = jaccard_join.near_duplicates(docs).collect()
    assert {(r["doc_id"] - r["class_id"] < 3 and r["class_id"] % 3 == 0, r["n_links"]) for r in got} == {(True, 2)}


def test_recall_on_a_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.near_duplicates(table).collect()}
    want = {i: (c, n) for i, c, n, _ in _links([tuple(r) for r in table.collect()])}
    ends = sum(n for _, n in want.values())
    assert sum(n for _, n in got.values()) >= 0.999 * ends and all(got[i][1] <= n for i, (_, n) in want.items())
    assert ends > 100 and sum(got[i] != w for i, w in want.items()) <= 0.001 * ends


def test_token_counts_leave_a_task_as_one_row_per_block(spark, monkeypatch):
    """Tokens of one set are not handed on, so what is shuffled grows with the sets and not with their tokens."""
    monkeypatch.setattr(jaccard_join, "NODE", 64)
    rnd = np.random.default_rng(3)
    shared = rnd.integers(1, 1 << 62, 30)
    sets = [(rep, [*shared.tolist(), *rnd.integers(1, 1 << 62, 20).tolist()]) for rep in range(640)]
    nodes = spark.createDataFrame([(5, rep, len(sets)) for rep, _ in sets], "node long, rep long, n long")
    found = jaccard_join._counts(nodes, spark.createDataFrame(sets, "rep long, tokens array<long>"), 0.8).collect()
    assert len(found) == 10
    # A set of so few tokens is looked at in full.
    assert sum(r["pairs"] for r in found) / sum(r["possible"] for r in found) == pytest.approx(0.6)
    held = {}
    for r in found:
        for child, n in zip(r["common"], r["n"], strict=True):
            held[child] = held.get(child, 0) + n
    key = jaccard_join.mix(np.array([5], dtype=np.uint64) ^ jaccard_join.mixed(7))[0]
    assert held == dict.fromkeys(jaccard_join.signed(jaccard_join.mix(shared.astype(np.uint64) + key)).tolist(), len(sets))


def _lined(n, seed=4):
    """Texts of sixty words of their own and a line of ten that all hold."""
    rnd = np.random.default_rng(seed)
    line = " ".join(f"licence{x}" for x in range(10))
    return [(i, " ".join(f"w{x}" for x in rnd.integers(0, 1 << 60, 60)) + " " + line) for i in range(n)]


@pytest.mark.parametrize("sample", [400, 4096])
def test_a_line_of_many_texts_makes_no_large_node(sample, spark, monkeypatch):
    # Before, every text that followed a token of the line was counted and split, with some six children each.
    monkeypatch.setattr(jaccard_join, "NODE", 64)
    monkeypatch.setattr(jaccard_join, "SAMPLE", sample)
    judged, counts = [], jaccard_join._counts
    monkeypatch.setattr(jaccard_join, "_counts", lambda nodes, *args: judged.append(nodes.count()) or counts(nodes, *args))
    for n in (1000, 2000):
        docs = spark.createDataFrame(_lined(n), "doc_id long, text string").repartition(8)
        assert jaccard_join.near_duplicates(docs).agg({"n_links": "sum"}).first()[0] == 0
    assert sum(judged) == 0


def test_widespread_tokens_are_those_of_lines_not_of_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "NODE", 64)
    body = " ".join(f"b{x}" for x in range(60))
    copies = [(1000 + i, f"{body} tail{i}") for i in range(300)]
    source = spark.createDataFrame(_lined(700) + copies + [(5000, None), (5001, "")], "doc_id long, text string").selectExpr("doc_id", "text", "xxhash64(text) text_hash")
    line = jaccard_join.Words(*jaccard_join.buffers(jaccard_join.pa.array([" ".join(f"licence{x}" for x in range(10))])), 0, 1)
    assert jaccard_join._widespread(source, 5, 0.8).tolist() == sorted(jaccard_join.shingles(line, 5)[1].tolist())
    monkeypatch.setattr(jaccard_join, "NODE", 2000)
    assert not len(jaccard_join._widespread(source, 5, 0.8))


def test_links_of_texts_of_any_share_of_widespread_tokens(spark, monkeypatch):
    # Pairs whose texts hold between 5 and 80 of 100 words of a passage; any tokens may be widespread, here all of it.
    monkeypatch.setattr(jaccard_join, "NODE", 32)
    rnd, rows = np.random.default_rng(9), []
    for k in range(400):
        common = 5 + (k * 75) // 399
        own = [f"w{x}" for x in rnd.integers(0, 1 << 60, 100 - common)]
        text = [f"passage{x}" for x in range(common)] + own
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join([*text[:-1], "changed"] + [f"more{k}"] * (k % 3)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    passage = jaccard_join.Words(*jaccard_join.buffers(jaccard_join.pa.array([" ".join(f"passage{x}" for x in range(80))])), 0, 1)
    monkeypatch.setattr(jaccard_join, "_widespread", lambda *_: np.sort(jaccard_join.shingles(passage, 5)[1]))
    got = sorted((tuple(r)[:4] for r in jaccard_join.near_duplicates(docs).collect()), key=repr)
    assert got == _links(rows)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95])
def test_two_similar_sets_follow_the_same_kind_of_tokens(threshold):
    rnd, (low, high) = np.random.default_rng(2), jaccard_join._edges(threshold)
    shared = rnd.integers(1, 400, 200_000)
    lack = np.floor(shared * (1 - threshold) / threshold * rnd.random(len(shared)))
    x = np.floor(lack * rnd.choice([0, 0.3, 1], len(shared)))
    y = lack - x
    # Tokens that are not widespread: of those shared, and of those of one set alone.
    a, b, c = (np.floor(n * rnd.choice([0, 0.4, 0.5, 0.7, 1], len(shared))) for n in (shared, x, y))
    one, two = (a + b) / (shared + x), (a + c) / (shared + y)
    assert (((one >= low) & (two >= low)) | ((one < high + 1e-9) & (two < high + 1e-9))).all()
