import io
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rumbo.llm import mixing, queries, rabitq, sharding, simhash, warc
from rumbo.llm.common import scratch


# ---- 3 WARC ------------------------------------------------------------------

def pages(llm, rows):
    return llm.createDataFrame(rows, "page_id long, url string, html string, sha string, holder long")


def test_round_trip_by_hand(llm):
    rows = [(1, "http://a", "same", "x", 9), (2, None, "same", None, None), (5, "http://c\r\nInjected: 1", "same", "x", 1), (3, "u", "", "", 1),
            (4, "u", None, "", 1), (7, "u", "é" * 40000, "", 1), (5, "http://c", "same", "x", 1), (None, "n", "only", None, None)]
    got = Counter(tuple(r) for r in warc.archive_round_trip(pages(llm, rows), split_bytes=64).collect())
    want = Counter()
    holder = {"same": 5, "": 4}
    for p, _, html, *_ in rows:
        body = (html or "").encode()
        h = holder.get(html or "")
        revisit = h is not None and p is not None and p < h
        want[(p, len(body), warc.digest_of(body), "revisit" if revisit else "response", h if revisit else None)] += 1
    assert got == want
    assert warc.archive_round_trip(pages(llm, [])).count() == 0
    longer = warc.archive_round_trip(pages(llm, rows), min_bytes=5).collect()
    assert {r["record_type"] for r in longer} == {"response"}


def test_payloads_come_back_whole(llm, sf_dir):
    table = llm.read.parquet(f"{sf_dir}/pages.parquet")
    files = warc.write_archives(table.repartition(3), scratch(llm, "warc-test"))
    back = {r["page_id"]: r["payload"] for r in warc.read_archives(files, split_bytes=20_000).collect()}
    assert back == {r["page_id"]: r["html"].encode() for r in table.collect()}


def test_every_byte_range_owns_its_records_once():
    r = random.Random(4)
    fixed = []
    for i in range(40):
        body = bytes(r.choices(range(256), k=r.randint(0, 3000))) + warc.MAGIC * 3
        fixed.append(warc.member(warc.record(i, f"u{i}", body, warc.digest_of(body), None, False)))
    data = b"".join(fixed)
    for split in (1000, 4097, 50_000, len(data)):
        found = [x["page_id"] for s in range(0, len(data), split)
                 for x in warc.read_range(io.BytesIO(data), len(data), s, min(s + split, len(data)))]
        assert found == list(range(40))


# ---- 5 nearest neighbours ----------------------------------------------------

def brute_force(rows, k):
    ids = np.array([i for i, _ in rows])
    m = np.array([v for _, v in rows], np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        s = m @ m[q]
        order = [i for i in np.lexsort((ids, -np.round(s, 12))) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [int(ids[i]) for i in order]
    return out


def test_neighbours_against_brute_force(llm, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in llm.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = defaultdict(list)
    for r in sorted(queries.op5_rotated_codes(llm, sf_dir).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append(r["vec_id"])
    want = brute_force(rows, 5)
    assert set(got) == set(want)
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) >= 0.99


def test_neighbours_with_copies_and_odd_rows(llm, monkeypatch):
    monkeypatch.setattr(rabitq, "CODE_BLOCK", 16)
    monkeypatch.setattr(rabitq, "QUERY_BLOCK", 2)
    r = np.random.default_rng(8)
    common = r.standard_normal(6).round(3).tolist()
    rows = [(i, common if i % 3 == 0 else r.standard_normal(6).round(3).tolist()) for i in range(200)]
    odd = [(500, None), (550, [0.0] * 6), (600, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (650, [float("nan")] * 6), (700, [1.0] * 5), (None, common), (0, common)]
    df = llm.createDataFrame([(i, v, 1.0) for i, v in rows + odd], "vec_id long, embedding array<float>, score double")
    got = defaultdict(list)
    for x in sorted(rabitq.search(df, F.col("id") % 50 == 0).collect(), key=lambda x: (x["query_id"], x["rank"])):
        got[x["query_id"]].append(x["vec_id"])
    assert got == brute_force([(i, np.array(v, np.float32)) for i, v in rows], 5)
    assert rabitq.search(df.limit(0), F.col("id") % 50 == 0).count() == 0
    assert rabitq.search(df.filter("vec_id in (0, 3)"), F.col("id") == 0).count() == 1


def test_error_bound_holds():
    r = np.random.default_rng(3)
    v, q, turn = r.standard_normal((2000, 64)), r.standard_normal((20, 64)), rabitq.rotation(64, 256)
    code, f = rabitq.encode(v, turn)
    signs = np.unpackbits(code, axis=1) * 2.0 - 1
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    error = np.abs((unit(q) @ turn.T) @ signs.T / 16 / f - unit(q) @ unit(v).T)
    assert (error <= rabitq.EPS * np.sqrt((1 - f * f) / (f * f) / 255)).mean() > 0.995


# ---- 9 shards ----------------------------------------------------------------

def check_shards(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert set(counts) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))


def test_shards_hold_the_law_and_keep_groups(llm, sf_dir, documents):
    rows = queries.op9_balanced_shards(llm, sf_dir).collect()
    check_shards(rows, 40)
    text = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert {r["doc_id"] for r in rows} == set(text) and all(r["size"] == len(text[r["doc_id"]].encode()) + 16 for r in rows)
    groups = defaultdict(set)
    for r in rows:
        groups[text[r["doc_id"]]].add(r["shard"])
    copies = Counter(text.values())
    # every group fits a shard here, so none is cut
    assert sum(len(groups[t]) - 1 for t, n in copies.items() if n > 1) == 0


def test_shards_of_one_large_group(llm):
    rows = [(i, "same" if i % 2 else f"text {i}") for i in range(300)]
    got = sharding.shard_documents(llm.createDataFrame(rows, "doc_id long, text string"), shards=7).collect()
    check_shards(got, 7)


def shards_of_texts(llm, texts, shards):
    rows = sharding.shard_documents(llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), shards=shards).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    check_shards(rows, shards)
    out = defaultdict(set)
    for r in rows:
        out[texts[r["doc_id"]]].add(r["shard"])
    return out


@pytest.mark.parametrize("size", [2, 5, 20, 100])
def test_shards_keep_every_group_that_fits_whole(llm, size):
    texts = [f"copy {i // size}" if i < 2000 else f"text {i}" for i in range(4000)]
    assert all(len(s) == 1 for s in shards_of_texts(llm, texts, 10).values())


def test_shards_keep_groups_whole_when_every_row_is_linked(llm):
    got = shards_of_texts(llm, [f"pair {i // 2}" if i < 3000 else f"group {i // 50}" for i in range(6000)], 10)
    assert all(len(s) == 1 for s in got.values())


def test_shards_rounds_end_with_whole_groups(llm):
    # small groups only, so that the rounds settle them, and as many as the quotas hold
    got = shards_of_texts(llm, [f"pair {i // 2}" for i in range(8000)], 4)
    assert all(len(s) == 1 for s in got.values())


def test_shards_gather_a_text_larger_than_a_shard(llm):
    got = shards_of_texts(llm, ["hot" if i % 3 == 0 else f"copy {i // 6}" if i < 3000 else f"text {i}" for i in range(6000)], 40)
    assert len(got.pop("hot")) == 14 and all(len(s) == 1 for s in got.values())


def test_shards_cut_few_groups_when_not_all_fit(llm):
    # shards of 100 rows: eleven groups of 60 on ten of them, pairs and triples fill every gap
    texts = [f"group {i // 60}" for i in range(660)] + [f"triple {i // 3}" for i in range(300)] + [f"pair {i // 2}" for i in range(40)]
    got = shards_of_texts(llm, texts, 10)
    assert sum(len(s) - 1 for s in got.values()) <= 9


@pytest.mark.parametrize("linked,room", [(4000, 900), (4000, 410), (4000, 400), (1000, 400)])
def test_rounds_never_cut_more_links(llm, linked, room):
    """Labels move towards their neighbours' under quotas: the cut falls, no shard passes its room by a move."""
    rows = llm.range(linked).select(F.col("id").alias("row"), F.md5((F.col("id") % (linked // 5)).cast("string")).cast("binary").alias("g"))
    groups = sharding.groups_of(rows, "row", "g", 10)
    start = groups.select("g", F.explode("labels").alias("l")).select("g", F.col("l.shard").alias("shard"), (-F.col("l.less")).alias("n"))
    before = {r["shard"]: r["n"] for r in start.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    labels, cuts = sharding.propagate(start, [room] * 10)
    after = {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    assert sum(after.values()) == linked and all(b <= a for a, b in zip(cuts, cuts[1:])) and cuts[-1] == sharding.cut_links(labels)
    assert all(after[s] <= max(room, before[s]) for s in after)
    if room == 900:
        assert cuts[-1] == 0 and len(cuts) > 1
    elif linked == 4000 and room == 400:
        assert cuts[0] > cuts[-1]


def test_settle_cuts_only_what_fits_nowhere():
    room = [10, 10, 11]
    got = sharding.settle([(b"a", 25, [0, 1, 2]), (b"b", 4, [1, 2]), (b"c", 2, [0])], room)
    assert got == {b"a": [(2, 11), (0, 10), (1, 4)], b"b": [(1, 4)], b"c": [(1, 2)]} and room == [0, 0, 0]
    # by votes d is cut, by best fit nothing
    four = [(b"a", 5, [1]), (b"b", 4, [1]), (b"c", 3, [0]), (b"d", 3, [0])]
    assert [len(sharding.settle(four, [5, 10], tight)[b"d"]) for tight in (False, True)] == [2, 1]


def test_shards_odd_rows(odd_docs, no_docs):
    rows = sharding.shard_documents(odd_docs, shards=3).collect()
    assert len(rows) == 10
    check_shards(rows, 3)
    assert sharding.shard_documents(no_docs, shards=3).count() == 0


# ---- 10 mixing ---------------------------------------------------------------

def targets_by_hand(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / (sum(w[s] for s in free) or 1)
        over = {s: 3.0 * sizes[s] for s in free if level * w[s] > 3 * sizes[s]}
        if not over:
            return {**capped, **{s: level * w[s] for s in free}}
        capped.update(over)


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 10}, {"a": 1, "b": 1000, "c": 5, "é": 7, None: 50}, {"x": 4}, {"a": 0, "b": 9},
                                   {chr(97 + i): (i * 37) % 11 + 1 for i in range(20)}])
def test_targets_against_repeated_resharing(llm, sizes):
    df = llm.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(targets_by_hand(sizes))


def check_mix(rows):
    by_source = defaultdict(list)
    for doc, source, r in rows:
        by_source[source].append(r)
    want = targets_by_hand({s: sum(r["size"] for r in x) for s, x in by_source.items()})
    for s, x in by_source.items():
        assert x[0]["target"] == pytest.approx(want[s]) and x[0]["source_size"] == sum(r["size"] for r in x)
        assert abs(sum(r["taken"] for r in x) - want[s]) <= max(r["size"] for r in x)
        epochs = int(want[s] // x[0]["source_size"]) if x[0]["source_size"] else 0
        for r in x:
            assert r["taken"] % max(r["size"], 1) == 0 and r["size"] * epochs <= r["taken"] <= min(3, epochs + 1) * r["size"]


@pytest.mark.parametrize("bucket", [5, 2000])
def test_mix_reaches_its_targets(llm, sf_dir, documents, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", bucket)
    out = queries.op10_source_mix(llm, sf_dir)
    rows = out.collect()
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    check_mix([(r["doc_id"], source[r["doc_id"]], r) for r in rows])
    assert sorted(rows) == sorted(queries.op10_source_mix(llm, sf_dir).collect())


def selection_by_hand(rows, targets):
    """Words taken of each row of ``mix-documents``: the order of keys, ids, hashes and row numbers, summed one by one."""
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    out = {}
    for source, own in by_source.items():
        size = sum(r["size"] for r in own)
        epochs = int(targets[source] // size) if size else 0
        left, going = targets[source] - epochs * size, True
        for r in sorted(own, key=lambda r: (r["key"], r["id"] is not None, r["id"] or 0, r["h"], r["row"])):
            going = going and left > 0 and 2 * left >= r["size"]
            out[r["row"]] = r["size"] * (epochs + going)
            left -= r["size"] if going else 0
    return out


@pytest.mark.parametrize("bucket", [7, 50_000])
def test_selection_equals_a_sum_row_by_row(llm, documents, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", bucket)
    twice = documents.select("doc_id", "text", "source").unionByName(documents.filter("doc_id % 9 = 0").select("doc_id", "text", "source"))
    slim = mixing._slim(twice, mixing.quality_weight(F.col("text")), 2024, "doc_id", "text", "source")
    placed, plan = mixing._plan(slim, (5, 2, 1), 3)
    rows = slim.collect()
    targets = targets_by_hand({s: sum(r["size"] for r in rows if r["source"] == s) for s in {r["source"] for r in rows}})
    want = selection_by_hand(rows, targets)
    assert plan.count() == len(targets) and placed.count() == len(rows)
    got = mixing.mix(twice).collect()
    assert sorted((r["doc_id"], r["size"], r["taken"]) for r in got) == sorted((r["id"], r["size"], want[r["row"]]) for r in rows)


def test_a_budget_may_end_among_repeated_rows(llm, monkeypatch):
    """300 equal rows of ten words take their target to within a row, and no partition holds them all."""
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 40)
    text = "ten words make up the whole of this short text"
    docs = llm.createDataFrame([(1, text, "a")] * 300 + [(2 + i, text, "b") for i in range(60)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, weights=(1, 1)).collect()
    for source, n in (("a", 300), ("b", 60)):
        own = [r for r in rows if (r["doc_id"] == 1) == (source == "a")]
        assert len(own) == n and abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 5
        assert {r["taken"] // 10 for r in own} <= {int(own[0]["target"] // own[0]["source_size"]), int(own[0]["target"] // own[0]["source_size"]) + 1}
    got = Counter(r["source"] for r in mixing.mixed_documents(docs, weights=(1, 1)).collect())
    assert got == {"a": sum(r["taken"] for r in rows if r["doc_id"] == 1) // 10, "b": sum(r["taken"] for r in rows if r["doc_id"] != 1) // 10}
    slim = mixing._slim(docs, F.lit(1.0), 2024, "doc_id", "text", "source")
    placed, _ = mixing._plan(slim, (1, 1), 3)
    assert max(r["count"] for r in placed.groupBy("part").count().collect()) <= 4 * 40


def test_buckets_are_even_for_uneven_weights(llm, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 500)
    docs = llm.range(20_000).selectExpr("id AS doc_id", "'a b' AS text", "'s' AS source", "IF(id % 2 = 0, 1.0D, 0.05D) AS quality")
    slim = mixing._slim(docs, F.col("quality"), 1, "doc_id", "text", "source")
    placed, _ = mixing._plan(slim, (1,), 3)
    assert max(r["count"] for r in placed.groupBy("part").count().collect()) <= 4 * 500


def test_mixed_documents_with_clashing_names(llm):
    names = ["doc_id", "text", "source", "__mix_s2", "mix_plan", "mix_hash", "sid", "cut", "key", "h", "row"]
    docs = llm.createDataFrame([(i, f"some words {i}", "ab"[i % 2], "x", "x", "x", "x", "x", "x", "x", "x") for i in range(20)],
                               ", ".join(f"`{n}` {'long' if n == 'doc_id' else 'string'}" for n in names))
    assert mixing.mixed_documents(docs).columns == names and mixing.mix(docs).count() == 20


def test_mix_prefers_quality(llm):
    df = llm.range(4000).selectExpr("id AS doc_id", "'one two three' AS text", "CASE WHEN id < 2000 THEN 'a' ELSE 'b' END AS source",
                                    "IF(id % 2 = 0, 1.0D, 0.1D) AS quality")
    rows = [r for r in mixing.mix(df, weights=(1, 3), weight=F.col("quality")).collect() if r["doc_id"] < 2000 and r["taken"]]
    good = sum(r["doc_id"] % 2 == 0 for r in rows) / len(rows)
    assert 0.75 < good <= 1


def test_mixed_documents_repeat_as_often_as_taken(documents):
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(documents).collect() if r["size"]}
    got = Counter(r["doc_id"] for r in mixing.mixed_documents(documents).collect())
    assert got == Counter({d: n for d, n in taken.items() if n})


def test_mix_odd_rows(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == 10 and {r["size"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0}
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0
    assert mixing.mixed_documents(odd_docs).columns == odd_docs.columns


# ---- pipeline ----------------------------------------------------------------

def test_pipeline_stages(llm, sf_dir, documents):
    docs, kept = documents, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(llm, docs, sf_dir).cache()
        assert docs.columns == documents.columns
        kept.append(Counter(r["doc_id"] for r in docs.select("doc_id").collect()))
    labels = {r["doc_id"]: r for r in llm.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good, clean, single, mixed = kept
    wrong = [d for d, r in labels.items() if (d in good) != (r["quality"] == 1)]
    assert len(wrong) <= 0.03 * len(labels)
    assert set(clean) <= set(good) and sum(r["toxic"] for d, r in labels.items() if d in clean) <= 3
    fps = {r["id"]: r["component_id"] for r in simhash.near_duplicates(documents.filter(F.col("doc_id").isin(list(clean)))).collect()}
    assert Counter(set(fps.values())) == single
    assert set(mixed) <= set(single) and max(mixed.values()) <= 3
    packed = corpus_pipeline.STAGES[-1][1](llm, docs, sf_dir).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == mixed
