"""Merkle manifest, source divergence and threshold table against brute force on whole small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rumbo.llm import divergence, merkle, queries, rules

WORD = re.compile("[^\x20\x09-\x0D]+")
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHES = "doc_id long, text string, lang string, source string, n_chars long, m int, leaf string, grp int, tree int, held int, rule_words int, rule_measures int, n int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---- 11 Merkle manifest ------------------------------------------------------

def as_leaf(doc_id, source, lang, n_chars, text):
    value = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    return sha(*map(value, (doc_id, source, lang, n_chars, text)))


def levels_of(hexes):
    out = [hexes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def audit_by_hand(rows):
    """Sorted (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    runs = defaultdict(list)
    for r in rows:
        plain = as_leaf(r.doc_id, r.source, r.lang, r.n_chars, r.text)
        bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
        other = as_leaf(r.doc_id, r.source, r.lang, r.n_chars if r.n_chars is None else r.n_chars + 1, r.text) if bad else plain
        runs[r.lang].append((r.doc_id, plain, other))
    langs = sorted(runs, key=lambda x: (x is not None, (x or "").encode()))
    trees = [levels_of([x[1] for x in sorted(runs[lang], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for lang in langs]
    top = levels_of([t[-1][0] for t in trees])
    out = []
    for k, lang in enumerate(langs):
        for i, (doc_id, plain, other) in enumerate(sorted(runs[lang], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
            h, siblings = other, []
            for levels, at in ((trees[k], i), (top, k)):
                for level in levels[:-1]:
                    beside = level[at ^ 1] if (at ^ 1) < len(level) else None
                    h = sha(h) if beside is None else sha(h, beside) if at % 2 == 0 else sha(beside, h)
                    siblings += [] if beside is None else [beside]
                    at //= 2
            out.append((doc_id, plain, trees[k][-1][0], top[-1][0], sha(*siblings), h, h == top[-1][0]))
    return sorted(out, key=str)


def audited(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_manifest_equals_brute_force(llm, documents, sf_dir):
    got = queries.op11_merkle_manifest(llm, sf_dir)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = got.collect()
    assert sorted(map(tuple, rows), key=str) == audit_by_hand(documents.collect())
    assert len({r["root"] for r in rows}) == 1 and {r["verified"] for r in rows} == {True, False}


def test_manifest_odd_rows(llm, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text", "lang", "source", "n_chars").collect()
    assert audited(merkle.audit(odd_docs)) == audit_by_hand(rows)
    assert merkle.audit(no_docs).count() == 0
    one = odd_docs.filter("doc_id = 7")
    (r,) = merkle.audit(one).collect()
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == sha() and r["verified"]
    clash = llm.createDataFrame([(8, "x", "en", "s", 1, 0, "l", 0, 0, 0, 0, 0, 0)], CLASHES)
    assert audited(merkle.audit(clash)) == audit_by_hand([SimpleNamespace(doc_id=8, text="x", lang="en", source="s", n_chars=1)])


def test_manifest_in_small_blocks_and_repeated_rows(llm):
    """Several rounds of blocks, runs of any length, a row repeated over block borders, many groups."""
    rows = [(i, f"text {i}", f"l{i % 5}" if i % 11 else None, "s", i) for i in range(1, 180)]
    rows += [(500, "same", "l1", "s", 4)] * 41 + [(77, "other text of this id", "l2", "s", 3)] * 3
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    one_more = (F.col("n_chars") + 1).cast("string")
    for bits, ranges in ((1, 7), (2, 50), (3, 10_000)):
        m = merkle.build(docs, altered={"n_chars": one_more}, where=merkle.tampered(), bits=bits, rows_per_range=ranges)
        got = merkle.prove(m).select("id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256), "folded_root",
                                     F.col("folded_root") == F.col("root"))
        assert audited(got) == audit_by_hand([SimpleNamespace(**r.asDict()) for r in docs.collect()])
        sizes = {r["tree"]: r["size"] for r in m.groups.collect()}
        stored = Counter((r["tree"], r["level"]) for r in m.nodes.collect() if r["tree"] >= 0)
        assert stored == {(t, k): merkle.width(n, k) for t, n in sizes.items() for k in range(merkle.depth(n) + 1)}


def test_partial_proofs_fetch_the_smallest_set(llm):
    docs = llm.createDataFrame([(i, f"t{i}", "en" if i % 3 else "de", "s", i) for i in range(200)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    m = merkle.build(docs, bits=4)
    every = {r["id"]: r for r in merkle.prove(m).collect()}
    some = m.leaves.filter(F.col("id").isin(1, 2, 4, 5, 100, 198))
    part = merkle.prove(m, some).collect()
    assert sorted(r["id"] for r in part) == [1, 2, 4, 5, 100, 198]
    assert all(r == every[r["id"]] and r["folded_root"] == r["root"] for r in part)
    wanted = merkle.wanted_nodes(m, some).collect()
    assert len(set(wanted)) == len(wanted)          # a partition asks for each node once
    by_proof = sum(len(r["proof"]) for r in part)
    assert len([w for w in wanted if w["tree"] != merkle.TOP]) < by_proof


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70), st.data())
def test_missing_nodes_are_minimal_and_enough(size, data):
    places = sorted(data.draw(st.sets(st.integers(0, size - 1), min_size=1)))
    levels = levels_of([sha(str(i)) for i in range(size)])
    asked = merkle.missing_nodes(places, size)
    nodes = {(0, p): levels[0][p] for p in places} | {(k, i): levels[k][i] for k, i in asked}
    merkle.derive(nodes, places, size)
    assert nodes[merkle.depth(size), 0] == levels[-1][0]
    for p in places:
        assert merkle.fold(levels[0][p], merkle.path(nodes, p, size)) == levels[-1][0]
    for k, i in asked:      # no leaf of the set lies below a fetched node, and one lies below its sibling
        assert not any(p >> k == i for p in places) and any(p >> k == i ^ 1 for p in places)


# ---- 12 source divergence ----------------------------------------------------

def divergence_by_hand(rows, least, smoothing, scale, top):
    docs = [((r.lang or ""), (r.source or ""), Counter(TERM.findall((r.text or "").translate(LOWER)))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df, whole, by = Counter(), Counter(), defaultdict(Counter)
        for _, source, terms in (d for d in docs if d[0] == lang):
            df.update(set(terms))
            whole.update(terms)
            by[source].update(terms)
        kept = sorted(t for t in df if df[t] >= least)
        shares = lambda c: {t: 1 + scale * (c[t] + smoothing) // (sum(c[x] for x in kept) + smoothing * len(kept)) for t in kept}  # noqa: E731,B023
        p, q = {s: shares(c) for s, c in by.items()}, shares(whole)
        for s in by:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in by if o != s]
            terms = [(q[t] - p[s][t], t) for t in kept if by[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, item, -v, k + 1) for k, (v, item) in enumerate(sorted(found, key=lambda x: (x[0], x[1].encode()))[:most])]
    return sorted(out)


def diverged(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_divergence_equals_brute_force(llm, documents, sf_dir):
    got = diverged(queries.op12_source_divergence(llm, sf_dir))
    assert got == divergence_by_hand(documents.collect(), 30, 5, 10 ** 9, 50)
    assert {r[2] for r in got} == {"pair", "term"}


def test_divergence_odd_rows(llm, odd_docs, no_docs):
    rows = odd_docs.collect()
    assert diverged(divergence.audit(odd_docs, min_documents=1)) == divergence_by_hand(rows, 1, 5, 10 ** 9, 50)
    none = diverged(divergence.audit(odd_docs))         # no term in 30 documents: pairs at distance 0, no terms
    assert none == divergence_by_hand(rows, 30, 5, 10 ** 9, 50) and {(r[2], r[4]) for r in none} == {("pair", 0)}
    assert divergence.audit(no_docs).count() == 0
    clash = llm.createDataFrame([(8, "x y", "en", s, 1, 0, "l", 0, 0, 0, 0, 0, 0) for s in "ab"], CLASHES)
    assert diverged(divergence.audit(clash, min_documents=1)) == divergence_by_hand(clash.collect(), 1, 5, 10 ** 9, 50)


def test_divergence_copies_ties_and_unequal_bases(llm):
    """Copies within and across sources, sources of very different size, equal values, terms of both, one and no source."""
    rows = [("Alpha beta ÄÖ beta", "en", s) for s in "aab"] + [("gamma delta", "en", "c")] * 5 + [("beta beta2x", "en", "d")]
    rows += [(f"w{i % 9} v{i % 4} alpha " * (i % 6), "en", f"s{i % 3}") for i in range(60)] + [("", "en", "empty"), (None, "en", None)]
    rows += [("mot mot", "fr", "only")] * 4
    docs = llm.createDataFrame(rows, "text string, lang string, source string")
    for least, top, smoothing in ((1, 50, 5), (3, 2, 1), (4, 1, 100)):
        got = diverged(divergence.audit(docs, min_documents=least, top=top, smoothing=smoothing))
        assert got == divergence_by_hand([SimpleNamespace(**r.asDict()) for r in docs.collect()], least, smoothing, 10 ** 9, top)


def test_shares_are_exact_beyond_64_bits(llm):
    big = 10 ** 17 + 3
    (r,) = llm.range(1).select(divergence.share(F.lit(big), F.lit(3 * 10 ** 17 + 1), 5, 10 ** 9).alias("p")).collect()
    assert r["p"] == 1 + 10 ** 9 * (big + 5) // (3 * 10 ** 17 + 1)


def test_each_text_is_tokenised_once(llm):
    docs = llm.createDataFrame([("same text", "en", f"s{i % 3}") for i in range(3000)] + [("other", "en", "s0")], "text string, lang string, source string")
    rows = divergence.distinct_texts(docs).collect()
    assert sorted((r["text"], sorted((h["source"], h["n"]) for h in r["held"])) for r in rows) == [
        ("other", [("s0", 1)]), ("same text", [("s0", 1000), ("s1", 1000), ("s2", 1000)])]


# ---- 13 threshold table ------------------------------------------------------

def measured_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
            "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words)}


def test_rules_equal_brute_force(llm, documents, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = queries.op13_rule_table(llm, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = measured_by_hand(texts[r["doc_id"]])
        assert {k: r[k] for k in own if k != "n_lines"} == {k: v for k, v in own.items() if k != "n_lines"}
        assert not (r["kept"] and r["base_failed"])


def test_rules_follow_the_labels(llm, sf_dir):
    labels = llm.read.parquet(f"{sf_dir}/labels.parquet")
    rows = queries.op13_rule_table(llm, sf_dir).join(labels, "doc_id").collect()
    good = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    junk = [r for r in rows if r["quality"] == 0]
    assert good and junk and all(r["kept"] for r in good)
    assert sum(r["kept"] for r in junk) <= 0.02 * len(junk)


def test_rules_run_no_python(llm, sf_dir):
    plan = queries.op13_rule_table(llm, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    assert plan.count("regexp_extract_all") == 1 and plan.count("split(") == 1      # each text is split once


def test_rules_odd_rows(llm, odd_docs, no_docs):
    rows = rules.judge(odd_docs).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_repeat_words"]) for r in rows) == sorted(
        (str(r["doc_id"]), measured_by_hand(r["text"])["n_words"], measured_by_hand(r["text"])["n_repeat_words"]) for r in odd_docs.collect())
    assert all(r["base_failed"] and not r["kept"] for r in rows)
    assert rules.judge(no_docs).count() == 0 and rules.keep_good(no_docs).columns == no_docs.columns
    clash = llm.createDataFrame([(8, "the quick word and of " * 2 + " ".join(f"one{i}" for i in range(60)), "en", "s", 1, 0, "l", 0, 0, 0, 0, 0, 0)], CLASHES)
    kept = rules.keep_good(clash)
    assert kept.columns == clash.columns and kept.count() == 1
    assert rules.judge(clash.union(clash)).count() == 2


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "#", "\n", " ", "\t", "\x0b", "é", " ", "|"]), max_size=40), min_size=1, max_size=8))
def test_measures_of_any_text(llm, texts):
    texts = [" ".join(t) if i % 2 else "".join(t) for i, t in enumerate(texts)]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit("xx"))
    for r in rules.judge(docs).collect():
        own = measured_by_hand(texts[r["doc_id"]])
        assert {k: r[k] for k in own} == own


def test_table_is_compiled_as_written(llm):
    table = (rules.Rule("short words", "word_chars", "n_words", low=2.0, high=4.0), rules.Rule("few symbols", "n_symbols", high=1),
             rules.Rule("english only", "n_stop_words", "n_words", low=0.5, langs=("en",)))
    filler = " ".join(f"x{i:02d}" for i in range(60))
    docs = llm.createDataFrame([(1, filler, "fr"), (2, filler, "en"), (3, filler + " # #", "fr"), (4, filler.replace("x", "xxxxxx"), None)],
                               "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["kept"], r["failed_rules"]) for r in rules.judge(docs, table).collect()}
    assert got == {1: (True, []), 2: (False, ["english only"]), 3: (False, ["few symbols"]), 4: (False, ["short words"])}
    assert [r["doc_id"] for r in rules.keep_good(docs, table).collect()] == [1]
    assert {r["kept"] for r in rules.judge(docs, ()).collect()} == {True}
    with pytest.raises(Exception):
        rules.judge(docs, (rules.Rule("unknown", "no_such_measure", high=1),)).collect()
