"""Operators on documents against brute force, with nulls, empties, repeats, empty tables and clashing names."""

import collections
import hashlib
import itertools
import re

import pytest
from pyspark.sql import functions as F

from tabulith.llm import queries
from tabulith.llm.common import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def bag(text):
    w = words(text)
    if not w:
        return collections.Counter()
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def similarity(a, b):
    low = sum((a & b).values())
    return low / max(1, sum((a | b).values()))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None) for i, t, s in rows], DOCS)


def test_near_duplicates_against_all_pairs(spark, sf_dir):
    from tabulith.llm.dart_minhash import near_duplicates

    docs = table(spark, sf_dir, "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    bags = {k: bag(v) for k, v in text.items()}
    label = {k: k for k in text}

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    for a, b in itertools.combinations(sorted(text), 2):
        if text[a] == text[b] and text[a] is not None or bags[a] and similarity(bags[a], bags[b]) >= 0.8:
            x, y = sorted((top(a), top(b)))
            label[y] = x
    found = {r.doc_id: (r.class_id, r.kept) for r in near_duplicates(docs).select("doc_id", "class_id", "kept").collect()}
    assert found == {k: (top(k), top(k) == k) for k in text}


def test_near_duplicates_edges(spark):
    from tabulith.llm.dart_minhash import near_duplicates

    long = " ".join(f"w{i % 97}x{i}" for i in range(30_000))
    rows = [(1, None, None), (2, None, "a"), (3, "!!", "a"), (4, "!!", "a"), (5, "", "a"), (6, "two words", "a"), (7, "Two  words", "a"), (7, "Two  words", "a"), (8, long, None), (9, long + " end", None), (None, "no key at all", "b")]
    docs = documents(spark, rows).withColumn("class_id", F.lit("clash")).withColumn("kept", F.lit(0))
    got = sorted(((r.doc_id, r.text), r.class_id) for r in near_duplicates(docs).collect() if r.doc_id)
    assert [c for _, c in got] == [1, 2, 3, 3, 5, 6, 6, 6, 8, 8]
    assert near_duplicates(docs).filter("kept").groupBy("class_id").count().filter("count > 1").count() == 0
    assert near_duplicates(documents(spark, [])).count() == 0


def test_dart_signatures_estimate_the_weighted_similarity():
    import pyarrow as pa

    from tabulith.llm.byte_words import words_of
    from tabulith.llm.dart_minhash import signatures

    a = " ".join(f"k{i % 300}" for i in range(900))
    b = " ".join(f"k{i % 300}" for i in range(500)) + " " + " ".join(f"z{i}" for i in range(100))
    sigs = signatures(next(words_of(pa.array([a, b]))), 4096)
    assert abs((sigs[0] == sigs[1]).mean() - similarity(bag(a), bag(b))) < 0.04


def test_decontamination_against_brute_force(spark):
    from tabulith.llm.decontamination import clean_documents, contamination

    phrase = [f"p{i}" for i in range(14)]
    items = [(1, " ".join(phrase)), (10, "Only Three WORDS"), (2, None), (3, "..."), (4, "é ü ñ"), (4, "é ü ñ")]
    docs = documents(
        spark,
        [
            (1, "a b " + " ".join(phrase) + " c only three words", "s"),
            (2, " ".join(phrase[:9]), "s"),
            (3, "x, ONLY-three.words; É ü ñ é\tü ñ " + " ".join(phrase[2:13]), None),
            (4, None, "s"),
            (5, "", "s"),
            (5, "", "s"),
            (6, "only three", "s"),
            (7, "words " * 50_000 + "only three words", "s"),
        ],
    )
    bench = spark.createDataFrame(items, "item_id long, text string")

    def expect(text):
        w, hit, ids = words(text), set(), set()
        for i, t in items:
            q = words(t)
            n = min(10, len(q))
            for s in range(len(q) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == q[s : s + n]:
                        hit |= set(range(p, p + n))
                        ids.add(str(i))
        return len(w), sorted(hit), sorted(ids)

    got = sorted((r.key, (r.n_words, r["hits"], r["items"])) for r in contamination(docs, bench).collect())
    assert got == sorted((r.doc_id, expect(r.text)) for r in docs.collect())
    assert sorted(r.doc_id for r in clean_documents(docs, bench).collect()) == [2, 4, 5, 5, 6]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, empty).filter(F.size("hits") > 0).count() == 0
    assert clean_documents(docs, empty).count() == docs.count()
    assert contamination(documents(spark, []), bench).count() == 0


def test_decontamination_by_groups_of_items_is_the_same(spark, sf_dir):
    from tabulith.llm.decontamination import build_index, item_groups, phrase_matches

    index = build_index(table(spark, sf_dir, "documents"))
    bench = table(spark, sf_dir, "benchmark")
    whole, parts = list(item_groups(bench)), list(item_groups(bench, limit=300))
    assert len(parts) > 2
    rows = [sorted((r.key, r.n_words, r["hits"], r["items"]) for r in phrase_matches(index, g).collect()) for g in (whole, parts)]
    assert rows[0] == rows[1]


def test_proximity():
    import pyarrow as pa

    from tabulith.llm.byte_words import words_of
    from tabulith.llm.decontamination import Postings, proximity

    index = Postings.of(next(words_of(pa.array(["a b c d e", "c x x x x x a", "e"]))))
    assert proximity(index, ["c", "a"], 3) == [(0, 0)] or proximity(index, ["c", "a"], 3) == [(0, 2)]
    assert len(proximity(index, ["a", "c"], 7)) == 2
    assert proximity(index, ["a", "q"], 7) == []


def fill(sizes, weights, budget, epochs):
    target, over = {}, set()
    while True:
        free = [s for s in sizes if s not in over]
        left = budget - sum(epochs * sizes[s] for s in over)
        total = sum(weights[s] for s in free)
        target = {s: left * weights[s] / total for s in free} | {s: epochs * sizes[s] for s in over}
        more = {s for s in free if target[s] > epochs * sizes[s]}
        if not more:
            return target
        over |= more


def test_mixing_targets_and_takes(spark, sf_dir):
    from tabulith.llm.mixing import mix

    docs = table(spark, sf_dir, "documents").unionByName(documents(spark, [(-1, "one two", None), (-2, None, None), (-3, " \t\n", "zz"), (-4, "three", "")]))
    got = mix(docs, keep=("source",)).collect()
    rows = docs.collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    assert {r.doc_id: r._size for r in got} == size
    sizes = collections.Counter()
    for r in rows:
        sizes[r.source] += size[r.doc_id]
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target = fill(sizes, weights, 1.5 * sum(sizes.values()), 2.0)
    taken = collections.Counter()
    for r in got:
        assert 0 <= r._taken <= 2 * r._size
        assert r._target == pytest.approx(target[r.source]) and r._source_size == sizes[r.source]
        taken[r.source] += r._taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    again = mix(docs.repartition(7), keep=("source",)).collect()
    assert sorted((r.doc_id, r._taken) for r in got) == sorted((r.doc_id, r._taken) for r in again)


def test_mixing_edges(spark):
    from tabulith.llm.mixing import mix, mixed_documents

    assert mix(documents(spark, [])).count() == 0
    assert mix(documents(spark, [(1, None, None)])).collect()[0]._taken == 0
    twice = documents(spark, [(1, "a b c", "x")] * 3 + [(None, "d", "x")])
    assert sum(r._taken for r in mix(twice).collect()) == 15
    assert mixed_documents(twice.withColumn("_size", F.lit("clash"))).columns == [*twice.columns, "_size"]
    with pytest.raises(ValueError):
        mix(twice, share=3.0)


def test_min_cost_flow_moves_the_least():
    from tabulith.llm.resharding import min_cost_flow

    flow = min_cost_flow([50, 30, 20, 0], [25, 25, 25, 25])
    assert [sum(r) for r in flow] == [50, 30, 20, 0] and [sum(c) for c in zip(*flow, strict=True)] == [25] * 4
    assert sum(flow[i][j] for i in range(4) for j in range(4) if i != j) == 30
    cost = [[4, 1, 3], [2, 0, 5], [3, 2, 2]]
    best = min(sum(cost[i][p[i]] for i in range(3)) for p in itertools.permutations(range(3)))
    f = min_cost_flow([1, 1, 1], [1, 1, 1], cost)
    assert sum(f[i][j] * cost[i][j] for i in range(3) for j in range(3)) == best


def test_resharding(spark, sf_dir):
    import zlib

    from tabulith.llm.resharding import reshard

    docs = table(spark, sf_dir, "documents").unionByName(documents(spark, [(-1, None, None), (-1, None, None), (None, "é", "x")]))
    got = reshard(docs).collect()
    want = collections.Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert collections.Counter((r._key, r._size, r._crc) for r in got) == want
    load = collections.Counter()
    for r in got:
        load[r._shard] += r._size
    assert set(load) == set(range(8)) and max(load.values()) - min(load.values()) < 0.02 * sum(load.values()) / 8
    for s in load:
        assert sorted(r._slot for r in got if r._shard == s) == list(range(sum(r._shard == s for r in got)))
    old = collections.Counter()
    for r in got:
        old[r._old] += r._size
    least = sum(max(0, n - sum(old.values()) / 8) for n in old.values())
    assert sum(r._size for r in got if r._old != r._shard) <= 1.02 * least
    assert reshard(documents(spark, [])).count() == 0


def test_rewrite_only_affected_blocks(spark, tmp_path):
    from tabulith.llm.resharding import old_layout, rewrite_affected

    docs = documents(spark, [(i, f"text {i}", "s") for i in range(60)])
    store = str(tmp_path / "store")
    old_layout(docs, 2).withColumn("_block", F.col("_block") % 4).withColumnsRenamed({"_old": "shard", "_block": "block"}).write.partitionBy("shard", "block").parquet(store)
    before = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    plan = {(0, 0): 0, (0, 1): 2, (0, 2): 0, (0, 3): 0, (1, 0): 1, (1, 1): 1, (1, 2): 1, (1, 3): 2}
    done = rewrite_affected(spark, store, plan)
    after = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    assert len(done) == 2 and all(after.get(p) == t for p, t in before.items() if "shard=0/block=1" not in p and "shard=1/block=3" not in p)
    rows = spark.read.parquet(store)
    assert sorted(r._key for r in rows.collect()) == list(range(60)) and rows.filter("shard = 2").count() > 0


def test_url_filter_against_brute_force(spark, sf_dir):
    from tabulith.llm.url_filter import judge_urls, rule_table

    urls = [(r.page_id, r.url) for r in table(spark, sf_dir, "pages").collect()]
    urls += [(-1, None), (-2, "no scheme"), (-3, "http://"), (-4, "HTTP://EXAMPLE.com/en/x?y#z"), (-5, "http://www.example.com/en/"), (-6, "http://notexample.com/en/"), (-7, "a://b.net/es/"), (-7, "a://b.net/es/"), (-8, "http://x.com"), (-9, "http://y.net/fr?/fr/"), (-10, "x://net/fr/://com/"), (-11, "http://é.com/\n/")]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("rule", F.lit(1)).withColumn("host", F.lit(2))

    def judge(url):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, "allow"))
        return host, path, rule, verdict

    got = sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in judge_urls(pages, rule_table(spark, queries.URL_RULES)).collect())
    assert got == sorted((i, *(x or "" for x in judge(u))) for i, u in urls)
    none = judge_urls(pages, spark.createDataFrame([], "verdict string, rule_host string, rule_path string"))
    assert {r.verdict for r in none.collect()} == {"allow"}
    assert judge_urls(pages.limit(0), rule_table(spark, queries.URL_RULES)).count() == 0


def test_queries_give_a_row_for_each_document(spark, sf_dir):
    n = table(spark, sf_dir, "documents").count()
    for name in ("op3_minhash_near_dedup", "op4_decontamination", "op5_mixing", "op10_sharding"):
        assert queries.QUERIES[name](spark, sf_dir).count() == n, name
    assert hashlib.sha256(b"").hexdigest() in {r.items_sha256 for r in queries.QUERIES["op4_decontamination"](spark, sf_dir).collect()}
