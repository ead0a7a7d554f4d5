"""Media, html, licenses, tokens, languages and the pipeline, against plain versions of them."""

import collections
import hashlib
import io
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulith.llm import queries
from tabulith.llm.common import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], DOCS)


# --- media ---


def slow_mulaw(byte):
    u = ~byte & 0xFF
    t = (((u & 0xF) << 3) + 0x84) << ((u & 0x70) >> 4)
    return 0x84 - t if u & 0x80 else t - 0x84


def slow_alaw(byte):
    a = byte ^ 0x55
    t, seg = (a & 0xF) << 4, (a & 0x70) >> 4
    t = t + 8 if seg == 0 else (t + 0x108) << (seg - 1)
    return t if a & 0x80 else -t


def slow_ima(block):
    from tabulith.llm.media import INDEX_MOVES, STEPS

    sample, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
    out = [sample]
    for byte in block[4:]:
        for code in (byte & 15, byte >> 4):
            step = int(STEPS[index])
            delta = step >> 3
            for bit, part in ((4, step), (2, step >> 1), (1, step >> 2)):
                delta += part if code & bit else 0
            sample = max(-32768, min(32767, sample - delta if code & 8 else sample + delta))
            index = max(0, min(88, index + int(INDEX_MOVES[code & 7])))
            out.append(sample)
    return out


def test_codecs_against_one_sample_at_a_time():
    from tabulith.llm.media import ALAW_TABLE, MULAW_TABLE, decode_ima

    assert MULAW_TABLE.tolist() == [slow_mulaw(b) for b in range(256)]
    assert ALAW_TABLE.tolist() == [slow_alaw(b) for b in range(256)]
    blocks = np.random.default_rng(3).integers(0, 256, (40, 36), dtype=np.uint8)
    assert decode_ima(blocks).tolist() == [slow_ima(bytes(b)) for b in blocks]


def test_waves_round_trip_and_resampling():
    from tabulith.llm.media import ALAW, IMA, MULAW, PCM, decode, from_wave, resample, to_wave

    body = bytes(range(256)) * 3
    for format_, block in ((MULAW, 1), (ALAW, 1), (IMA, 36), (PCM, 2)):
        assert from_wave(to_wave(body, format_, 8000, block)) == (format_, 8000, block, body)
        rate, pcm = decode(to_wave(body, format_, 8000, block))
        assert rate == 8000 and pcm.dtype == np.int16 and len(pcm)
    assert resample(np.array([0, 10, -10, 4], np.int16), np.array([2, 4])).tolist() == [0, 5, 10, 10, -10, -3, 4, 4]
    for bad in (b"", b"RIFF", b"x" * 50):
        with pytest.raises(ValueError):
            decode(bad)


def test_media_query(spark, sf_dir):
    from tabulith.llm.media import audio_features, resampled_pcm, store_as_audio

    rows = [(1, None), (2, ""), (3, "é" * 288), (4, "é" * 288), (5, "x" * 300_000), (None, "a"), (6, "a"), (6, "a")]
    docs = documents(spark, rows).withColumn("media", F.lit(1))
    stored = store_as_audio(docs, F.col("text"), "doc_id")
    got = {(r.key, r.n_bytes): r for r in audio_features(stored).collect()}
    for i, t in rows:
        body = (t or "").encode()
        pad = body + b"\xff" * (max(1, -(-len(body) // 576)) * 576 - len(body))
        r = got[i, len(body)]
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-32:]))
    assert got[3, 576].feature == got[4, 576].feature and got[3, 576].media_sha256 == got[4, 576].media_sha256
    assert got[1, 0].payload_bytes == 576
    assert audio_features(store_as_audio(documents(spark, []), F.col("text"), "doc_id")).count() == 0
    up = resampled_pcm(stored.unionByName(spark.createDataFrame([(9, 0, None)], "key long, n_bytes long, media binary"))).collect()
    assert sum(r.media is None for r in up) == 1 and all(r.media[20] == 1 for r in up if r.media)
    assert queries.QUERIES["op2_media"](spark, sf_dir).count() == table(spark, sf_dir, "documents").count()


# --- html ---


def test_html_rules():
    from tabulith.llm.html_extraction import main_text

    prose = "The cat sat on the mat and it was as happy as the dog that lay by the fire in the hall. " * 4
    page = f"""<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var t="</p><p>no</p>";</script></head><body>
      <nav><ul><li><a href=/>Menu</a></li></ul></nav><!-- no --><div class="cookie notice">We use cookies, and you agree to it.</div>
      <article><header><h1>A&nbsp;title &amp; more</h1></header><p>{prose}<br>Next&#33;</p><p>Short one.</p>
      <aside>Buy now, it is the best of all.</aside><form><p>Your name</p></form><p><a href=x>Only a link in here, really</a></p>
      <section id="comments"><p>{prose}</p></section><p>Last <b>bold</b> words</p></article>
      <div class="sidebar"><p>{prose}</p></div><footer>&copy; me</footer></body></html>"""
    body = re.sub(r"\s+", " ", prose).strip()
    assert main_text(page) == f"A title & more {body} Next! Short one. Last bold words"
    assert main_text(None) == main_text("") == main_text("<p>") == main_text("<script>never closed <p>x") == ""
    assert main_text(f"<div><a href=1>home</a></div><p>{prose}</p><p>And so on.</p>") == f"{body} And so on."
    assert main_text("<article><p>a &lt; b &amp;lt; c</p></article>") == "a < b &lt; c"
    assert main_text(f'<main><div class="post-header"><h1>Heading</h1></div><p>{prose}</p><ul class="share-links"><li>Post it</li></ul></main>') == f"Heading {body}"
    assert main_text(f'<nav><a href="/">never closed</nav><article><p>{prose}</p></article>') == body
    assert main_text(f"<article><p>{prose} cut off <b") == f"{body} cut off"
    assert main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def test_html_drops_no_text_of_articles_or_of_other_languages():
    from tabulith.llm.html_extraction import main_text

    body = ("The cat sat on the mat and it was as happy as the dog that lay by the fire in the hall. " * 4).strip()
    for name in ("content has-sidebar", "no-comments", "right-sidebar", "with-nav"):
        assert main_text(f'<div class="{name}"><article><p>{body}</p></article><div class="sidebar"><p>{body}</p></div></div>') == body
        assert main_text(f'<div id="{name}"><p>{body}</p></div><p>And so on.</p>').startswith(body)
    assert main_text(f'<main class="has-sidebar"><article class="post no-comments"><p>{body}</p></article></main>') == body
    assert main_text(f'<article><p>{body}</p></article><div id="comments"><article><p>I am of the same mind as you.</p></article></div>') == body
    assert main_text(f"<article><p>{body}</p><figure><img src=x><figcaption>A cat.</figcaption></figure></article>") == f"{body} A cat."
    assert main_text(f"<article><p>{body}</p><ol><li>Doe: <a href=x>On the cats of the hall</a>, 1999.</li></ol></article>") == f"{body} Doe: On the cats of the hall, 1999."
    polish = "Wczoraj wieczorem nad rzeką spotkaliśmy starego rybaka, który opowiadał dzieciom historie sprzed wojny. " * 3
    chinese = "昨天晚上我们在河边遇见了一位老渔夫，他给孩子们讲了许多战争以前的故事。" * 8
    for text in (polish.strip(), chinese):
        assert main_text(f"<div><a href=1>{text[:80]}</a></div><div><p>{text}</p></div>") == text


def test_html_query_keeps_the_articles(spark, sf_dir):
    import html as entities

    from tabulith.llm.html_extraction import extract

    got = {r.page_id: r for r in queries.QUERIES["op6_html_extraction"](spark, sf_dir).collect()}
    pages = table(spark, sf_dir, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", p.html, re.S)[1]
        want = re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner)))).strip()
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want)
    odd = spark.createDataFrame([(1, None, "a"), (1, None, "a")], "page_id long, html string, text string")
    assert [(r.page_id, r.text, r.n_chars) for r in extract(odd).collect()] == [(1, "", 0)] * 2
    assert extract(odd.limit(0)).count() == 0


# --- licenses ---


def contained(text, template):
    from tabulith.llm.license_scan import words_of

    cut = lambda t: [tuple(w[i : i + 5]) for w in [words_of(t)] for i in range(len(w) - 4)]
    have, want = cut(text), set(cut(template))
    n = len(cut(template))
    return any(len(want & set(have[s : s + 2 * n])) >= 0.8 * len(want) for s in range(0, max(1, len(have)), n))


def test_license_scan(spark, sf_dir):
    from tabulith.llm.license_scan import TEMPLATES, scan

    long = dict(TEMPLATES)["MIT"]
    rows = [(1, None), (2, ""), (3, "license"), (4, "x " * 5000 + long + " y" * 5000), (5, long.upper() + "!"), (6, "Released under the MIT\n License. " * 3), (6, "Licensed under CC BY-NC 4.0."), (6, "Licensed under CC BY-NC 4.0.")]
    docs = table(spark, sf_dir, "documents").unionByName(documents(spark, rows)).withColumn("licenses", F.lit(0))
    got = collections.Counter((r.doc_id, tuple(r.licenses)) for r in scan(docs).collect())
    want = collections.Counter((r.doc_id, tuple(sorted({n for n, t in TEMPLATES if contained(r.text or "", t)}))) for r in docs.collect())
    assert got == want and sum(bool(k[1]) for k in want) > 5
    assert scan(documents(spark, [])).count() == 0
    assert queries.QUERIES["op7_license_scan"](spark, sf_dir).count() == table(spark, sf_dir, "documents").count()


def test_license_wherever_it_stands(spark):
    """An edited notice against containment at every offset."""
    from tabulith.llm.license_scan import scan, words_of

    notice = " ".join(f"word{i}" for i in range(44))
    edited = notice.split()[:22] + [f"new{i}" for i in range(20)] + notice.split()[22:]
    gone = [w for i, w in enumerate(notice.split()) if i % 6]
    texts = [" ".join([f"a{i}" for i in range(k)] + edited + [f"b{i}" for i in range(60)]) for k in range(80)]
    texts += [" ".join(gone), " ".join(notice.split()[:24] + ["far"] * 60 + notice.split()[24:]), f"{notice} {' '.join(edited)}"]
    cut = lambda t: [tuple(w[i : i + 5]) for w in [words_of(t)] for i in range(len(w) - 4)]
    want, n = set(cut(notice)), len(cut(notice))
    share = [max(len(want & set(have[s : s + 2 * n])) / len(want) for s in range(len(have))) for have in map(cut, texts)]
    got = {r.doc_id: r for r in scan(documents(spark, list(enumerate(texts))), [("N", notice)]).collect()}
    for i, x in enumerate(share):
        assert [(m.template, m.share) for m in got[i].matches] == ([(0, round(x, 6))] if x >= 0.8 else []), i
    assert [got[k].matches[0].first_word for k in range(80)] == list(range(80)) and min(share[:80]) == 0.9 and max(share[80:82]) < 0.8


# --- tokens ---


def test_permutation():
    from tabulith.llm.token_output import Permutation

    for n in (1, 2, 3, 17, 1000, 4097):
        p = Permutation(n, 5)
        slots = p.slot(np.arange(n))
        assert sorted(slots.tolist()) == list(range(n))
        assert p.index(slots).tolist() == list(range(n))
    assert Permutation(1000, 5).slot(np.arange(1000)).tolist() != Permutation(1000, 6).slot(np.arange(1000)).tolist()


def test_token_shards_round_trip(spark, sf_dir):
    from tabulith.llm.token_output import END, encoder, export_raw, read_shards, write_shards

    docs = documents(spark, [(i, f"Text number {i}. " * (i % 40)) for i in range(300)] + [(-1, None), (-2, "<|endoftext|> é "), (7, "again"), (None, "no id")])
    path = write_shards(docs, length=64, slots=100)
    rows = read_shards(spark, path, slots=100).collect()
    n = len(rows)
    assert sorted(r.slot for r in rows) == list(range(n)) and all(r.shard == r.slot // 100 and len(r.tokens) == 128 for r in rows)
    own = collections.defaultdict(dict)
    for r in rows:
        own[r.key].setdefault(r.seq, []).append(np.frombuffer(r.tokens, "<u2")[: r.n_tokens].tolist())
    for d in docs.collect():
        if d.text is None:
            assert d.doc_id not in own
        elif d.doc_id != 7:
            ids = [t for s in sorted(own[d.doc_id]) for t in own[d.doc_id][s][0]]
            assert ids[-1] == END and encoder().decode(ids[:-1]) == d.text
    raw = b""
    for shard in range(-(-n // 100)):
        out = io.BytesIO()
        export_raw(spark, path, shard, out)
        raw += out.getvalue()
    by_slot = {r.slot: bytes(r.tokens) for r in rows}
    assert raw == b"".join(by_slot[s] for s in range(n))
    assert sorted(r.slot for r in read_shards(spark, path, start=155, slots=100).collect()) == list(range(155, n))
    assert read_shards(spark, write_shards(documents(spark, []))).count() == 0
    assert queries.QUERIES["op8_token_output"](spark, sf_dir).filter("seq = 0").count() == table(spark, sf_dir, "documents").count()


# --- languages ---


def test_codewords_differ():
    from tabulith.llm.language_id import codewords

    for n in (1, 2, 3, 4, 5, 6, 40):
        code = codewords(n)
        assert len({tuple(c) for c in code.tolist()}) == n and set(np.unique(code)) <= {-1, 1}


def test_language_accuracy_on_the_held_out_fold(spark):
    got = queries.QUERIES["op9_language_id"](spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edges(spark):
    from tabulith.llm.language_id import identify, train

    docs = documents(spark, [(1, None), (2, ""), (3, "12 !? _"), (4, "ab"), (4, "ab"), (5, "the of and " * 20000)]).withColumn("score", F.lit("x"))
    assert train(docs) is None
    assert {r.lang_pred for r in identify(docs, None).collect()} == {"und"}
    one = train(docs.withColumn("lang", F.lit("aa")))
    assert [(r.doc_id, r.lang_pred) for r in identify(docs, one).sort("doc_id").collect()] == [(1, "und"), (2, "und"), (3, "und"), (4, "aa"), (4, "aa"), (5, "aa")]
    assert identify(docs.limit(0), one).count() == 0


# --- pipeline ---


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as p
    from tabulith.llm.decontamination import contamination
    from tabulith.llm.mixing import mix

    assert [n for n, _ in p.STAGES] == ["language", "near_dedup", "benchmark", "mixture", "tokens"]
    docs = table(spark, sf_dir, "documents")
    told = p.language(spark, docs, sf_dir)
    assert told.columns == docs.columns and {r.doc_id for r in docs.collect()} == {r.doc_id for r in told.collect()}
    junk = documents(spark, [(-5, "12 34 %%"), (-6, None)])
    assert p.language(spark, docs.unionByName(junk), sf_dir).filter("doc_id < 0").count() == 0
    kept = p.near_dedup(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    classes = {r.class_id for r in queries.QUERIES["op3_minhash_near_dedup"](spark, sf_dir).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(classes)
    clean = p.benchmark(spark, docs, sf_dir)
    hit = {r.key for r in contamination(docs, table(spark, sf_dir, "benchmark")).filter(F.size("hits") > 0).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - hit and hit
    times = collections.Counter(r.doc_id for r in p.mixture(spark, docs, sf_dir).collect())
    assert times == collections.Counter({r.doc_id: int(r._taken / r._size + 0.5) for r in mix(docs).collect() if r._size and int(r._taken / r._size + 0.5)})


def test_pipeline_run_is_its_stages_in_turn(spark, sf_dir):
    import corpus_pipeline as p
    from tabulith.llm.token_output import encoder

    rows = p.run(spark, sf_dir).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    docs = table(spark, sf_dir, "documents")
    for _, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    want = collections.Counter((r.doc_id, len(encoder().encode_ordinary(r.text)) + 1) for r in docs.collect())
    seqs = collections.Counter()
    for r in rows:
        seqs[r.doc_id] += r.n_tokens
    total = collections.Counter()
    for (i, n), k in want.items():
        total[i] += n * k
    assert seqs == total
