"""Brute force, clashing names, repeated rows, keys of any type, long texts, and the stores that operators write."""

import collections
import hashlib
import itertools
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tabulith.llm import queries
from tabulith.llm.common import dense_index, table
from tests.llm.test_corpus_operators import bag, fill, similarity, words
from tests.llm.test_text_operators import slow_alaw, slow_ima, slow_mulaw

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, kind="long"):
    return spark.createDataFrame(rows, DOCS.replace("long", kind, 1))


def docs_of(spark, pairs, kind="long"):
    return frame(spark, [(i, t, None, "s", None) for i, t in pairs], kind)


# --- shared pieces ---


def test_ties_are_numbered_in_many_partitions(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"  # else so few rows are put together again
    spark.conf.set(name, "false")
    try:
        got = dense_index(spark.range(2000, numPartitions=8).select(F.lit(1).alias("k")), [F.col("k")], "i", "ties")
        assert sorted(r.i for r in got.collect()) == list(range(2000))
        assert got.select(F.input_file_name().alias("f")).distinct().count() > 1
    finally:
        spark.conf.unset(name)


def test_long_texts_are_cut_into_words_by_pieces():
    from tabulith.llm.byte_words import words_of

    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("abcé ,.\n"), 5000))
    texts = [text, "x" * 300, None, "", " , ", text + "y" * 200 + " end"]
    whole = [w.hashes.tolist() for t in texts for w in words_of(pa.array([t], pa.string()), 1 << 20)]
    pieces = collections.defaultdict(list)
    for w in words_of(pa.array(texts, pa.string()), 64):
        for d in range(w.n):
            pieces[w.first + d] += w.hashes[w.bounds[d] : w.bounds[d + 1]].tolist()
    assert [pieces[i] for i in range(len(texts))] == whole


# --- 1: urls ---


def test_url_columns_of_any_name(spark):
    from tabulith.llm.url_filter import judge_urls, rule_table

    names = ["_h", "_p", "_of", "_url", "_won", "_host", "_path", "_row", "host", "verdict", "rule"]
    pages = spark.createDataFrame([(1, "http://a.b.example.com/en/x")], "page_id long, url string").withColumns({n: F.lit(n) for n in names})
    row = judge_urls(pages, rule_table(spark, queries.URL_RULES)).first()
    assert (row.host, row.verdict, row.rule) == ("a.b.example.com", "block", "example.com/en/")
    assert [row[n] for n in names[:8]] == names[:8]


def test_hosts_of_very_many_labels(spark):
    from tabulith.llm.url_filter import judge_urls, rule_table

    host = "a." * 50_000 + "net"
    pages = spark.createDataFrame([(1, f"http://{host}/fr/"), (2, "http://" + "b" * 200_000 + "/" + "c" * 200_000)], "page_id long, url string")
    got = {r.page_id: (len(r.host), r.verdict) for r in judge_urls(pages, rule_table(spark, queries.URL_RULES)).collect()}
    assert got == {1: (len(host), "block"), 2: (200_000, "allow")}


# --- 2: media ---


def test_media_against_one_sample_at_a_time(spark):
    from tabulith.llm.media import FACTOR, store_media

    rows = [("a", None), ("b", ""), ("c", "é" * 300), (None, "one"), ("d", "two words"), ("d", "two words"), ("e", "z" * 4000), ("f", "three")]
    got = store_media(docs_of(spark, rows, "string").withColumn("media", F.lit(1)), F.col("text"), "doc_id").collect()
    assert sorted(str(r.key) for r in got) == sorted(str(i) for i, _ in rows)
    codecs = set()
    for i, t in rows:
        body = (t or "").encode()
        pad = body + b"\xff" * (max(1, -(-len(body) // 576)) * 576 - len(body))
        r = next(x for x in got if x.key == i and x.n_bytes == len(body))
        name = r.feature.split(":")[0]
        codecs.add(name)
        if name == "ima":
            pcm = [s for k in range(0, len(pad), 36) for s in slow_ima(pad[k : k + 36])]
        else:
            pcm = [(slow_mulaw if name == "mulaw" else slow_alaw)(b) for b in pad]
        wide = [x for k, s in enumerate(pcm) for x in (s, s + (pcm[min(k + 1, len(pcm) - 1)] - s) // 2)]
        raw = b"".join(int(x).to_bytes(2, "little", signed=True) for x in wide)
        energy, crossings, peak = sum(x * x for x in wide), sum((a < 0) != (b < 0) for a, b in itertools.pairwise(wide)), max(map(abs, wide))
        assert r.feature == f"{name}:pcm16000:{zlib.crc32(raw):08x} energy:{energy} crossings:{crossings} peak:{peak}" and FACTOR == 2
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-32:]))
        assert bytes(r.pcm).endswith(raw) and len(r.pcm) - len(raw) == 58
        assert r.media_bytes == (60 if name == "ima" else 58) + len(pad)
    assert codecs == {"mulaw", "alaw", "ima"}


# --- 3: near-duplicates ---


def test_near_duplicates_of_a_thousand_documents_against_all_pairs(spark):
    """Recall over every pair at 0.8 or more: all of them end in one class, and no class holds more."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    bags = {k: bag(v) for k, v in text.items()}
    holders = collections.defaultdict(list)
    for k, b in bags.items():
        for s in b:
            holders[s].append(k)
    pairs = {p for own in holders.values() if len(own) < 400 for p in itertools.combinations(sorted(own), 2)}
    near = [(a, b) for a, b in pairs if text[a] == text[b] or similarity(bags[a], bags[b]) >= 0.8]
    label = {k: k for k in text}

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    for a, b in near:
        x, y = sorted((top(a), top(b)))
        label[y] = x
    found = {r.doc_id: r.class_id for r in queries.QUERIES["op3_minhash_near_dedup"](spark, "/root/testdata/sf0.01").collect()}
    assert len(near) > 50 and found == {k: top(k) for k in text}


def test_rows_that_are_alike_keep_one(spark):
    from tabulith.llm import dart_minhash

    was, dart_minhash.ALIKE = dart_minhash.ALIKE, 7
    try:
        docs = docs_of(spark, [(7, "the same text of a few words")] * 100 + [(8, "the same text of a few words"), (7, "other"), (None, None), (None, None)])
        got = dart_minhash.near_duplicates(docs.repartition(5).withColumns({"_node": F.lit(1), "_head": F.lit(2), "_row": F.lit(3)})).collect()
    finally:
        dart_minhash.ALIKE = was
    assert len(got) == 104 and collections.Counter((r.doc_id, r.text, r.kept) for r in got) == {
        (7, "the same text of a few words", True): 1, (7, "the same text of a few words", False): 99, (8, "the same text of a few words", False): 1, (7, "other", True): 1, (None, None, True): 2
    }
    assert {r._row for r in got} == {3}


# --- 4: decontamination ---


def test_index_with_keys_of_text_and_long_items(spark):
    from tabulith.llm.decontamination import build_index, contamination, item_groups, phrase_matches

    long = " ".join(f"t{i}" for i in range(200))
    docs = docs_of(spark, [("d-1", "a " + long + " b"), ("d-2", " ".join(long.split()[60:75])), (None, "x"), ("d-3", None)], "string").withColumns({"key": F.lit(1), "hits": F.lit(2)})
    bench = spark.createDataFrame([("one", long)], "item_id string, text string")
    got = {r.key: (r.n_words, len(r.hits), r["items"]) for r in contamination(docs, bench).collect()}
    assert got == {"d-1": (202, 200, ["one"]), "d-2": (15, 15, ["one"]), None: (1, 0, []), "d-3": (0, 0, [])}
    groups = list(item_groups(bench, limit=30))
    assert len(groups) > 5 and max(len(w) for g in groups for _, w in g) <= 30
    again = {r.key: (r.n_words, len(r.hits), r["items"]) for r in phrase_matches(build_index(docs), groups).collect()}
    assert again == got


def test_proximity_over_the_stored_index(spark):
    from tabulith.llm.decontamination import build_index, proximity_matches

    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abcdefg"), 60)) for _ in range(30)] + ["", None]
    items = [("abc", ["a", "b", "c"]), ("gz", ["g", "z"]), ("f", ["f"])]
    index = build_index(docs_of(spark, list(enumerate(texts))))
    got = collections.Counter((r.item, r.key) for r in proximity_matches(index, items, 4).select("item", "key").distinct().collect())
    want = set()
    for name, terms in items:
        for k, t in enumerate(texts):
            w = words(t)
            for rare in terms:  # documents where a match exists whichever term is the block's rarest
                near = any(all(x in w[max(0, p - 3) : p + 4] for x in terms) for p, y in enumerate(w) if y == rare)
                if near:
                    want.add((name, k, rare))
    every = {(n, k) for n, k, _ in want if all((n, k, t) in want for t in dict(items)[n])}
    some = {(n, k) for n, k, _ in want}
    assert every <= set(got) <= some and any(n == "abc" for n, _ in got) and not any(n == "gz" for n, _ in got)


# --- 5: mixing ---


def spark_hash(*values):
    seed = 42
    for v in values:
        if v is not None:
            body = v.encode() if isinstance(v, str) else int(v).to_bytes(4 if v == 17 and seed == 42 else 8, "little", signed=True)
            seed = xxhash.xxh64(body, seed=seed).intdigest()
    return seed


def mixed(rows):
    """(doc_id, words taken) of (doc_id, text, source) rows, one source after another in the order of the hash."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = collections.Counter()
    for (_, _, s), n in zip(rows, size, strict=True):
        sizes[s] += n
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, 1.5 * sum(sizes.values()), 2.0)
    out = []
    for s in names:
        own = sorted((spark_hash(17, i, t), -1 if i is None else i, n) for (i, t, x), n in zip(rows, size, strict=True) if x == s)
        want = int(target[s] + 0.5)
        left = want - want // sizes[s] * sizes[s] if sizes[s] else 0
        for _, i, n in own:
            more = max(0, min(n, left))
            left -= more
            out.append((i, (want // sizes[s] if sizes[s] else 0) * n + more))
    return sorted(out)


def test_mixing_against_brute_force(spark, sf_dir):
    from tabulith.llm.mixing import mix

    docs = table(spark, sf_dir, "documents").unionByName(frame(spark, [(5000, "one two three", None, None, None)] * 400))
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    for data in (docs, docs.repartition(9)):
        assert sorted((r.doc_id, r._taken) for r in mix(data).collect()) == mixed(rows)


def test_mixing_carries_columns_of_any_name(spark):
    from tabulith.llm.mixing import mixed_documents

    docs = frame(spark, [(1, "a b c", None, "x", 1)] * 50 + [(2, "d e", None, "x", 2)] * 30).withColumns({"_row": F.lit(1), "_hash": F.lit("h"), "_taken": F.lit(2)})
    got = mixed_documents(docs).collect()
    assert {(r._row, r._hash, r._taken) for r in got} == {(1, "h", 2)} and 300 <= sum(len(r.text.split()) for r in got) <= 330


# --- 6: html ---


def test_html_of_deep_nesting_costs_in_proportion():
    from tabulith.llm.html_extraction import main_text

    def took(n):
        page = "<div class=x><span>" * n + "text" + "<p>a" * n
        start = time.perf_counter()
        main_text(page)
        return time.perf_counter() - start

    took(1000)
    assert took(16_000) < 12 * max(took(4_000), 0.01)


def test_html_without_marks_in_more_languages(spark):
    from tabulith.llm.html_extraction import extract, main_text

    prose = {
        "it": "Il vecchio pescatore che abbiamo incontrato ieri sera vicino al fiume raccontava ai bambini le storie della guerra e non si è fermato fino a notte.",
        "pt": "O velho pescador que encontramos ontem junto ao rio contava histórias da guerra para as crianças e não parou até que a noite chegou de novo.",
        "nl": "De oude visser die wij gisteren bij de rivier zagen vertelde de kinderen over de oorlog en hij hield niet op tot het weer nacht was in het dorp.",
        "sv": "Den gamle fiskaren som vi mötte vid floden i går berättade om kriget för barnen och han slutade inte förrän det var natt och de hade somnat.",
        "pl": "Stary rybak, którego spotkaliśmy wczoraj nad rzeką, opowiadał dzieciom o wojnie i nie przestał, aż było już ciemno, a one po prostu zasnęły.",
        "ru": "Старый рыбак, которого мы встретили вчера у реки, рассказывал детям о войне и не остановился, пока не наступила ночь и они не уснули у огня.",
    }
    for text in prose.values():
        page = f"<nav><a href=/>Home</a> <a href=/b>News</a></nav><div class=menu><ul><li><a href=1>{text[:60]}</a></li></ul></div><div><p>{text} {text}</p><p>{text}</p></div><footer>(c) 2020</footer>"
        assert main_text(page) == f"{text} {text} {text}"
    odd = spark.createDataFrame([(1, "<article><p>x</p></article>")], "page_id long, html string").withColumns({"_row": F.lit(5), "_text": F.lit("t"), "text": F.lit(0)})
    row = extract(odd).first()
    assert (row.page_id, row.text, row.n_chars, row._row, row._text) == (1, "x", 1, 5, "t")


# --- 7: licenses ---


def test_every_occurrence_of_a_notice(spark):
    from tabulith.llm.license_scan import scan

    notice = " ".join(f"word{i}" for i in range(30))
    edited = notice.split()[:20] + ["new"] * 3 + notice.split()[20:]
    filler = [f"f{i}" for i in range(40)]
    text = " ".join(filler + notice.split() + notice.split() + filler + edited)
    docs = docs_of(spark, [(1, text), (2, " ".join(notice.split()[:12])), (3, None)]).withColumns({"x": F.lit(1), "_row": F.lit(2), "i": F.lit(3)})
    got = {r.doc_id: r for r in scan(docs, [("N", notice)]).collect()}
    assert [(o.first_word, o.last_word) for o in got[1].occurrences] == [(40, 69), (70, 99), (140, 172)]
    assert [(m.first_word, m.share) for m in got[1].matches] == [(40, 1.0)]
    assert got[2].licenses == got[2].occurrences == got[3].matches == []


def test_every_template_shingle_passes_the_gate(spark):
    from tabulith.llm.license_scan import TEMPLATES, gate_of, words_of

    runs = sorted({" ".join(w[i : i + 5]) for _, t in TEMPLATES for w in [words_of(t)] for i in range(len(w) - 4)})
    texts = [(i, f"x. {r.upper().replace(' ', ', ')}!") for i, r in enumerate(runs)] + [(-1, "no such thing"), (-2, None), (-3, "relicensed undercover")]
    got = {r.doc_id for r in docs_of(spark, texts).filter(gate_of(F.col("text"), TEMPLATES)).collect()}
    assert got == set(range(len(runs)))


# --- 8: tokens ---


def test_raw_shards_are_read_by_seeking(spark, tmp_path):
    from tabulith.llm.token_output import END, read_shards, read_slots, write_shards

    docs = docs_of(spark, [(f"k{i}", f"Text number {i}. é " * (i % 30)) for i in range(200)] + [(None, "no id"), ("none", None)], "string")
    path = write_shards(docs, str(tmp_path / "raw"), length=32, slots=64, raw=True)
    rows = {r.slot: (r.key, bytes(r.tokens)) for r in read_shards(spark, write_shards(docs, length=32, slots=64), slots=64, key="string").collect()}
    n = len(rows)
    files = sorted((tmp_path / "raw" / "raw").glob("shard=*/part-*"))
    assert len(files) == -(-n // 64) and sorted({p.stat().st_size for p in files})[-1] == 64 * 66
    index = {r.slot: r for r in spark.read.parquet(f"{path}/index").collect()}
    assert sorted(index) == list(range(n)) and all(index[s].key == rows[s][0] for s in rows)
    for start, count in ((0, n), (n - 1, 5), (60, 10), (63, 1), (n, 3)):
        got = read_slots(spark, path, start, count, length=32, slots=64)
        assert [x.tobytes() for x in got] == [rows[s][1] for s in range(start, min(n, start + count))]
    first = {(r.key, r.seq): s for s, r in index.items()}
    whole = np.concatenate([read_slots(spark, path, first["k29", q], 1, 32, 64)[0] for q in range(sum(k == "k29" for k, _ in first))])
    assert END in whole


def test_shards_hold_a_fixed_number_of_slots(spark):
    from tabulith.llm.token_output import read_shards, write_shards

    rows = read_shards(spark, write_shards(docs_of(spark, [(i, "a b c") for i in range(1000)]), slots=100), slots=100)
    assert {r["count"] for r in rows.groupBy("shard").count().collect()} == {100}
    assert rows.select("shard", F.input_file_name().alias("f")).distinct().count() == 10  # a file each


# --- 9: languages ---


def slow_features(text):
    from tabulith.llm.language_id import DIM

    out = np.zeros(DIM)
    body = bytes((b + 32 if 65 <= b <= 90 else b) if (97 <= b <= 122 or 65 <= b <= 90 or b >= 128) else 32 for b in text.encode())
    for k in range(1, 5):
        for i in range(len(body) - k + 1):
            gram = int.from_bytes(body[i : i + k], "big")
            out[((gram ^ (k * 0x9E3779B1 & 0xFFFFFFFF)) * 0x85EBCA6B & 0xFFFFFFFF) >> 20] += 1
    root = np.sqrt(out)
    return root / np.sqrt((root * root).sum()) if root.any() else root


def test_language_against_brute_force(spark, sf_dir):
    from tabulith.llm.language_id import codewords, held_out, identify, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out()))
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, model).collect()}
    rows = docs.collect()
    learnt = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 and r.lang and any(c.isalpha() for c in r.text or "")]
    x = np.array([slow_features(r.text) for r in learnt]).astype(np.float16).astype(np.float64)
    langs = sorted({r.lang for r in learnt})
    codes = codewords(len(langs)).astype(float)
    share = np.array([1 / sum(o.lang == r.lang for o in learnt) for r in learnt])
    share /= share.sum()
    own = np.array([langs.index(r.lang) for r in learnt])
    xm, ym = share @ x, share @ codes[own]
    a, b = (x - xm) * np.sqrt(share)[:, None], (codes[own] - ym) * np.sqrt(share)[:, None]
    w = np.linalg.solve(a.T @ a + 0.01 / len(a) * (a * a).sum() * np.eye(a.shape[1]), a.T @ b)
    side = x @ w + ym - xm @ w
    agree = np.clip((side * codes[own] * share[:, None]).sum(axis=0), 0.01, 1)
    trust = agree / agree.sum()
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id] == ("und", 0.0)
            continue
        s = slow_features(r.text) @ w + ym - xm @ w
        loss = [float((np.maximum(0, 1 - s * c) ** 2 * trust).sum()) for c in codes]
        assert got[r.doc_id][0] == langs[int(np.argmin(loss))]
        assert got[r.doc_id][1] == pytest.approx(1 / sum(np.exp(-8 * (v - min(loss))) for v in loss), abs=1e-3)


def test_features_of_long_texts_in_pieces():
    from tabulith.llm.language_id import features

    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abé 1"), n)) for n in (500, 64, 63, 65, 1, 0)] + [None]
    whole, pieces = features(pa.array(texts, pa.string())), features(pa.array(texts, pa.string()), 64)
    assert np.allclose(whole, pieces) and np.allclose(whole[0], slow_features(texts[0]), atol=1e-5)


def test_both_forms_of_the_fit_agree():
    from tabulith.llm.language_id import ridge

    a, b = np.random.default_rng(3).normal(size=(60, 40)), np.random.default_rng(4).normal(size=(60, 3))
    penalty = 0.01 / 60 * (a * a).sum()
    want = np.linalg.solve(a.T @ a + penalty * np.eye(40), a.T @ b)
    dual = a.T @ np.linalg.solve(a @ a.T + penalty * np.eye(60), b)
    assert np.allclose(ridge(a, b), want) and np.allclose(dual, want)


def test_what_a_letter_is(spark):
    from tabulith.llm.language_id import identify, train

    texts = ["², ½ Ⅷ ①", "_ 12", "é", "語", None, "x²"]
    docs = docs_of(spark, list(enumerate(texts))).withColumns({"_row": F.lit(1), "_some": F.lit(2), "score": F.lit("old")})
    one = train(docs.withColumn("lang", F.lit("aa")))
    got = {r.doc_id: (r.lang_pred, r._row, r._some) for r in identify(docs, one).collect()}
    assert got == {i: ("aa" if i in (2, 3, 5) else "und", 1, 2) for i in range(6)}


def test_many_labels_are_refused(spark):
    from tabulith.llm import language_id

    docs = docs_of(spark, [(i, "text") for i in range(1200)]).withColumn("lang", F.col("doc_id").cast("string"))
    with pytest.raises(ValueError):
        language_id.train(docs)


# --- 10: resharding ---


def test_rows_that_are_alike_lie_in_all_shards(spark):
    from tabulith.llm.resharding import reshard

    docs = docs_of(spark, [(7, "same text")] * 3000).repartition(6).withColumns({"shard": F.lit("s"), "block": F.lit("b"), "_row": F.lit(1)})
    got = reshard(docs).collect()
    load = collections.Counter(r._shard for r in got)
    assert set(load) == set(range(8)) and max(load.values()) - min(load.values()) <= 0.05 * 3000 / 8
    assert all(sorted(r._slot for r in got if r._shard == s) == list(range(load[s])) for s in load)
    assert {(r._row.shard, r._row.block, r._row._row) for r in got} == {("s", "b", 1)}


def test_a_resharded_store_holds_what_it_held(spark, tmp_path):
    from tabulith.llm.common import boxed
    from tabulith.llm.resharding import BLOCKS, even_capacities, read_store, reshard_store, write_store

    docs = docs_of(spark, [(i, f"text {i} " * (i % 50)) for i in range(900)] + [(None, None), (1, "again")])
    store = str(tmp_path / "store")
    write_store(docs, 3, store)
    before = {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    old = {(r._row.doc_id, r._row.text): (r.shard, r.block) for r in read_store(spark, store, boxed(docs).schema["_row"].dataType).collect()}
    plan = reshard_store(spark, store, lambda total: even_capacities(total, 5))
    rows = read_store(spark, store, boxed(docs).schema["_row"].dataType).collect()
    assert collections.Counter((r._row.doc_id, r._row.text) for r in rows) == collections.Counter((r.doc_id, r.text) for r in docs.collect())
    for r in rows:  # every row is where the plan has its block
        s, b = old[r._row.doc_id, r._row.text]
        assert r.shard == plan[s, b] and r.block == (b if r.shard == s else (s + 1) * BLOCKS + b)
    after = {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    stayed = [f"store/shard={s}/block={b}/" for (s, b), j in plan.items() if s == j]
    assert all(after.get(p) == t for p, t in before.items() if any(p.startswith(x) for x in stayed)) and any(s != j for (s, _), j in plan.items())


# --- pipeline ---


def tables(spark, tmp_path, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, "/root/testdata/sf0.001", "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_leave_columns_as_they_are(spark, tmp_path):
    import corpus_pipeline as p

    names = ["score", "ambiguous", "lang_pred", "kept", "class_id", "_row", "_size", "hits", "_node"]
    docs = table(spark, "/root/testdata/sf0.001", "documents").withColumns({n: F.lit(0.5) for n in names})
    at = tables(spark, tmp_path, docs)
    for _, stage in p.STAGES[:-1]:
        got = stage(spark, docs, at)
        assert got.schema == docs.schema or [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in docs.schema]
        assert got.filter(" OR ".join(f"{n} <> 0.5 OR {n} IS NULL" for n in names)).count() == 0 and got.limit(1).count()
    assert p.run(spark, at).count()


def test_pipeline_of_odd_tables(spark, tmp_path):
    import corpus_pipeline as p

    assert p.run(spark, tables(spark, tmp_path / "none", frame(spark, []))).count() == 0
    repeated = frame(spark, [(1, "one and the same text of some words", None, None, 1)] * 200 + [(None, None, None, None, None)] * 3 + [(2, "", "en", "s", 0), (3, "12 %", None, "s", 4)])
    got = p.run(spark, tables(spark, tmp_path / "same", repeated)).collect()
    assert {r.doc_id for r in got} == {1} and len(got) == 2  # one of the rows stays, and is taken in one and a half epochs, rounded


def test_pipeline_against_a_version_without_spark(spark, sf_dir):
    import corpus_pipeline as p
    from tabulith.llm.token_output import encoder

    items = [words(r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    grams = {tuple(w[s : s + min(10, len(w))]) for w in items if w for s in range(len(w) - min(10, len(w)) + 1)}
    lengths = {len(x) for x in grams}
    docs = [r for r in table(spark, sf_dir, "documents").collect() if any(c.isalpha() for c in r.text or "")]
    bags = {r.doc_id: bag(r.text) for r in docs}
    label = {r.doc_id: r.doc_id for r in docs}

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    for a, b in itertools.combinations(sorted(docs, key=lambda r: r.doc_id), 2):
        if a.text == b.text or similarity(bags[a.doc_id], bags[b.doc_id]) >= 0.8:
            x, y = sorted((top(a.doc_id), top(b.doc_id)))
            label[y] = x
    docs = [r for r in docs if top(r.doc_id) == r.doc_id]
    docs = [r for r in docs if not any(tuple(w[s : s + n]) in grams for w in [words(r.text)] for n in lengths for s in range(len(w) - n + 1))]
    taken = dict(mixed([(r.doc_id, r.text, r.source) for r in docs]))
    want = collections.Counter()
    for r in docs:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        want[r.doc_id] = int(taken[r.doc_id] / n + 0.5) * (len(encoder().encode_ordinary(r.text)) + 1) if n else 0
    rows = p.run(spark, sf_dir).collect()
    got = collections.Counter()
    for r in rows:
        got[r.doc_id] += r.n_tokens
    assert got == +want and sorted(r.slot for r in rows) == list(range(len(rows)))
