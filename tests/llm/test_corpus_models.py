"""Language-model scores, language ID, quality rules, mixing and token files on odd rows and by brute force."""

import base64
import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from docfacts.llm import html_text, language_id, lm_score, mixing, quality_bands, wavelet
from docfacts.llm.common import mix, pack, pack_sorted, runs, unpack, unpack_sorted
from docfacts.llm.queries import QUERIES, tokenizer_path
from tests.llm.cases import WORDS, frame, prose, rows, words


def held(doc_id, divisor, remainder):
    return zlib.crc32(str(doc_id).encode()) % divisor == remainder


def test_packing_is_exact():
    rng = np.random.default_rng(0)
    for a in (np.zeros(0, np.uint64), rng.integers(0, 2**63, 1000).astype(np.uint64)):
        assert (unpack(pack(a), np.uint64) == a).all()
        assert (unpack_sorted(pack_sorted(np.sort(a))) == np.sort(a)).all()
    assert runs(np.array([2, 0, 3])).tolist() == [0, 1, 0, 1, 2]
    assert len(np.unique(mix(np.arange(10_000)))) == 10_000


def test_base_scores_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    given = [tuple(r) for r in docs.collect()] + [(r[0], r[1]) for r in rows() if r[0] is not None]
    tokens = [(i, [w.encode().lower() for w in words(t)] + [None]) for i, t in given]
    counts = collections.Counter(w for i, ws in tokens if not held(i, 10, 0) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter()
    for i, ws in tokens:
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        want[i, held(i, 10, 0), len(ws), sum(counts[w] > 0 for w in ws), n, f"{base:.6g}"] += 1
    found = lm_score.score(spark.createDataFrame(given, "doc_id long, text string")).collect()
    got = collections.Counter((r[0], r[1], r[2], r[3], r[4], f"{r[5]:.6g}") for r in found)
    assert got == want
    out = [r for r in found if r.held_out]
    assert all(math.isfinite(r.score) and r.score <= 0 for r in found)
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_filter_keeps_every_count():
    keys = np.unique(mix(np.arange(5000)) >> np.uint64(16))
    counts = np.arange(len(keys)) % 40 + 1
    cuts = lm_score._cuts(keys, 48, 4)
    table = b"".join(lm_score.filter_slice(keys[a:b], counts[a:b], i, 2**18, 4) for i, (a, b) in enumerate(zip(cuts, cuts[1:])))
    got = lm_score.probe_levels(np.frombuffer(table, np.uint8), keys, 2**18, 4)
    assert (got >= lm_score.level(counts)).all() and (got == lm_score.level(counts)).mean() > 0.9
    absent = lm_score.probe_levels(np.frombuffer(table, np.uint8), keys ^ np.uint64(1), 2**18, 4)
    assert (absent == 0).mean() > 0.5


def test_filter_drops_no_count():
    """Rare n-grams stay in a slice that has few bits for them."""
    keys = np.unique(mix(np.arange(5000)) >> np.uint64(17))
    counts = np.arange(len(keys)) % 3 + 1
    table = np.frombuffer(lm_score.filter_slice(keys, counts, 0, 2**12, 2), np.uint8)
    assert (lm_score.probe_levels(table, keys, 2**12, 2) >= lm_score.level(counts)).all()


def exact_scores(given):
    """The model's scores by exact quantised counts."""
    tokens = [(i, [w.encode().lower() for w in words(t)] + [None]) for i, t in given]
    one, two = collections.Counter(), collections.Counter()
    for i, ws in tokens:
        if not held(i, 10, 0):
            one.update(ws)
            two.update(zip([None, *ws], ws))
    quantised = lambda c: float(lm_score.estimate(lm_score.level(np.array([c])))[0])
    one, two = ({k: quantised(c) for k, c in counts.items()} for counts in (one, two))
    spread = sum(one.values()) + 0.1 * (len(one) + 1)
    for i, ws in tokens:
        pairs = list(zip([None, *ws], ws))
        single = [math.log10((one.get(w, 0) + 0.1) / spread) for w in ws]
        double = [
            math.log10((min(two.get((h, w), 0), one.get(h, 0), one.get(w, 0)) + 10**p) / (one.get(h, 0) + 1))
            for (h, w), p in zip(pairs, single)
        ]
        ends = range(0, len(ws), 16)
        yield i, len(ws), sum(np.log10(0.9 * 10.0 ** sum(single[k : k + 16]) + 0.1 * 10.0 ** sum(double[k : k + 16])) for k in ends)


def test_scores_are_those_of_exact_counts_at_any_size(spark, sf_dir, monkeypatch):
    """Neither a limit of the filter nor the number of its slices changes what the model knows."""
    monkeypatch.setattr(lm_score, "MAX_BITS", 2**14, raising=False)
    monkeypatch.setattr(lm_score, "RANGE_BYTES", 50_000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").filter("length(text) < 20000")
    found = {r.doc_id: r.score for r in lm_score.score(docs).collect()}
    want = list(exact_scores([tuple(r) for r in docs.collect()]))
    assert len(found) == len(want)
    off = [abs(found[i] - s) / n for i, n, s in want]
    assert max(off) < 0.2 and sum(off) / len(off) < 0.01


@pytest.mark.parametrize("some", [rows(), []])
def test_scores_of_odd_rows(spark, some):
    found = lm_score.score(frame(spark, some)).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in some)
    assert all(r.n_tokens == 1 for r in found if r.doc_id in (1, 2, 3))


def test_language_on_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    found = [r for r in language_id.identify(docs).collect() if r.held_out]
    assert all(held(r.doc_id, 3, 1) for r in found)
    assert sum(truth[r.doc_id] == r.lang_pred for r in found) >= 0.97 * len(found)
    assert all(0 <= r.score <= 1 for r in found) and sum(r.rejected for r in found) <= 0.01 * len(found)


@pytest.mark.parametrize("learnt", [("en", "de"), ("en", "fr", "de")])
def test_a_language_that_was_not_learnt(spark, sf_dir, learnt):
    """The limit lies above an even guess for any number of languages; clean texts pass it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    known = docs.filter(F.col("lang").isin(*learnt))
    model = language_id.fit(known, F.col("lang"))
    assert 1 / len(learnt) < model.needed <= (1 + language_id.REJECT_EDGE * (len(learnt) - 1)) / len(learnt)
    texts = [r.text for r in known.collect() if len(words(r.text)) > 20]
    assert language_id.predict(model, texts)[2].mean() <= 0.02
    mixed = [language_id.predict(model, ["\u4e2d\u6587 \u0440\u0443\u0441 " * 5])]
    assert all(0 <= score[0] <= 1 for _, score, _ in mixed)


def test_language_of_odd_rows(spark):
    letterless = [(9, "123 456 !? ", "en", "a", 1, "m", 1, "c"), (10, "²", "en", "a", 1, "m", 1, "c")]
    found = language_id.identify(frame(spark, rows() + letterless)).collect()
    assert len(found) == len(rows()) + 2
    for r in found:
        assert (r.lang_pred == "und") == (r.score == 0.0)
        assert r.lang_pred == "und" if r.doc_id in (1, 2, 3, 9, 10) else r.lang_pred in ("en", "fr", "de", "es", "und")
    assert language_id.identify(frame(spark, [])).count() == 0
    unlabelled = [r[:2] + (None,) + r[3:] for r in rows()]
    assert {r.lang_pred for r in language_id.identify(frame(spark, unlabelled)).collect()} == {"und"}
    kept = language_id.accepted(frame(spark, rows() + letterless))
    assert kept.columns == frame(spark).columns and not {1, 2, 3, 9, 10} & {r.doc_id for r in kept.collect()}


def figures(text):
    w = words(text)
    times = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = {j for i in range(len(w) - 7) if times[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            lines += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), lines, len(again), failed


def test_quality_figures_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    given = [tuple(r) for r in docs.collect()] + [(r[0], r[1]) for r in rows()] + [(11, "a b\na b\n c\n\n" * 9), (12, "#|é " * 30)]
    found = quality_bands.measure(spark.createDataFrame(given, "doc_id long, text string")).collect()
    got = collections.Counter((r[0], *r[1:7]) for r in found)
    assert got == collections.Counter((i, *figures(t)) for i, t in given)
    assert not any(r.kept and r.base_failed for r in found)


def test_compression_bands(spark):
    rng = np.random.default_rng(1)
    noise = " ".join(bytes(rng.integers(33, 127, 60)).decode() for _ in range(300))
    varied = " ".join("".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(800))
    repeats = "\n".join(f"{i} the same line with another number" for i in range(900))
    found = quality_bands.measure(spark.createDataFrame([(1, noise), (2, varied), (3, repeats)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.kept for r in found} == {1: False, 2: True, 3: False}


def test_base64_of_each_length_is_rejected(spark):
    rng = np.random.default_rng(3)

    def base64_lines(n, width=76):
        data = base64.b64encode(rng.bytes(n)).decode()
        return "\n".join(data[i : i + width] for i in range(0, len(data), width))[:n]

    def varied(n):
        return " ".join("".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(n // 3))[:n]

    compressor = zstandard.ZstdCompressor(level=quality_bands.LEVEL)
    for n in (256, 400, 511, 512, 800, 1023, 1024, 1600, 4095, 4096, 9000, 40_000):
        for text, good in ((base64_lines(n), False), (varied(n), True)):
            assert quality_bands.within(n, *quality_bands.compression(text.encode(), compressor)) == good, (n, good)
    sizes = (1600, 2500, 3500, 4090, 6000, 20_000)
    texts = [base64_lines(n) for n in sizes]
    texts.append(varied(8000) + "\n" + base64_lines(12_000))
    texts.append(base64_lines(4096)[:4095] + "\n" + varied(4096) + base64_lines(3000))  # the last chunk tips it
    texts += [varied(n) for n in sizes]
    found = {r.doc_id: r for r in quality_bands.measure(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert not any(r.base_failed for r in found.values())
    assert [found[i].kept for i in range(len(texts))] == [False] * (len(sizes) + 2) + [True] * len(sizes)
    assert found[len(sizes) + 1].bad_chunks == pytest.approx(7096 / 11192)


def water_filled(sizes, weights):
    total, full = sum(sizes), set()
    while True:
        rest = total - sum(3 * sizes[i] for i in full)
        open_weight = sum(w for i, w in enumerate(weights) if i not in full)
        share = [3 * s if i in full else rest * weights[i] / open_weight for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if i not in full and share[i] > 3 * s}
        if not over:
            return share
        full |= over


@pytest.mark.parametrize("plus", [rows(), [(20 + i, prose(i, 30), "en", "rare", 1, "m", 1, "c") for i in range(3)]])
def test_mix_meets_its_targets(spark, sf_dir, plus):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.unionByName(frame(spark, plus).select("doc_id", "text", "lang", "source", "n_chars"))
    given = docs.collect()
    sizes = collections.Counter()
    for r in given:
        sizes[r.source] += len(words(r.text))
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    targets = dict(zip(names, water_filled([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])))
    found = mixing.report(docs).collect()
    assert sorted((str(r.doc_id), r.size) for r in found) == sorted((str(r.doc_id), len(words(r.text))) for r in given)
    assert all(0 <= r.taken <= 3 * r.size for r in found)
    by_target = collections.Counter()
    for r in found:
        by_target[r.source_size, round(r.target, 4)] += r.taken
    assert set(by_target) == {(sizes[s], round(targets[s], 4)) for s in names}
    assert all(abs(taken - target) <= 0.02 * target + 3 * mixing.BLOCK for (_, target), taken in by_target.items())
    assert sorted(map(str, mixing.report(docs).collect())) == sorted(map(str, found))
    mixed, of = mixing.mixed(docs), collections.Counter()
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        of[r.doc_id] += len(words(r.text))
    want = collections.Counter()
    for r in found:
        want[r.doc_id] += r.taken
    assert +of == +want


def test_mix_of_nothing(spark):
    assert mixing.report(frame(spark, [])).count() == 0
    assert mixing.mixed(frame(spark, [])).count() == 0
    assert [r.taken for r in mixing.report(frame(spark, rows()[:3])).collect()] == [0, 0, 0]


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000])
def test_permutation(n):
    assert sorted(mixing.permute(np.arange(n), n, 12345)) == list(range(n))


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for depth, n in ((6, 5000), (1, 513), (1, 1), (16, 700)):
        values = rng.integers(0, min(2**depth, 37), n)
        matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(values, depth).to_bytes())
        assert (matrix.decode() == values).all()
        assert all(matrix.access(i) == values[i] for i in range(0, n, 37))
        for x in set(values[:5].tolist()):
            places = np.flatnonzero(values == x)
            assert [matrix.select(x, k) for k in range(min(20, len(places)))] == places[:20].tolist()
            assert all(matrix.rank(x, i) == (places < i).sum() for i in (0, n // 3, n))
            with pytest.raises(IndexError):
                matrix.select(x, len(places))


def test_texts_are_cut_at_every_kind_of_white_space():
    """Slices of Arrow texts, cut by their bytes, give the ids of each whole text as the library does."""
    from tokenizers import Tokenizer

    rng, path = random.Random(5), tokenizer_path()
    encoder, library = wavelet.PieceEncoder(path), Tokenizer.from_file(path)
    parts = [*wavelet._SPACES, "  ", "\r\n", "\x1c", "\u200b", "\u00c2", "\u2080", "word", " don't,", "12", "é", "ü!", "漢字", "\u3001", "😀", "..."]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(2000)] + ["", " ", "\u3000", "\xa0x\u2029"]
    library.encode_special_tokens = True
    want = [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]
    for start, stop in ((0, 700), (700, 701), (701, len(texts))):
        found = encoder.encode(pa.array(texts).slice(start, stop - start))
        assert [x.tolist() for x in found] == want[start:stop]
    assert [x.tolist() for x in encoder.encode(texts)] == want
    assert encoder.encode(["", ""])[1].tolist() == [] and encoder.encode([]) == []


def test_token_files_round_trip(spark, sf_dir, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    odd = [(21, "a  b\n\n c\t\td   e\x1cf!\x1c g\x85h <|endoftext|> it's  we'll 　x   "), (22, " \n "), (23, "  x y")]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").filter("doc_id > 30")
    docs = docs.unionByName(spark.createDataFrame([(r[0], r[1]) for r in rows()] + odd, "doc_id long, text string"))
    given = sorted(docs.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    want, start = collections.Counter(), {}
    at = 0
    for r in given:
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        want[r.doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
        start.setdefault(r.doc_id, at)
        at += len(ids)
    wavelet.write(docs, f"{tmp_path}/t", tokenizer_path())
    found = wavelet.read(spark, f"{tmp_path}/t").collect()
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == want
    first = {}
    for r in found:
        first[r.doc_id] = min(r.start, first.get(r.doc_id, r.start))
    assert first == start
    ends = {r.place for r in wavelet.occurrences(spark, f"{tmp_path}/t", 2).collect()}
    assert {r.start + r.n_tokens - 1 for r in found} <= ends
    wavelet.write(docs.limit(0), f"{tmp_path}/none", tokenizer_path())
    assert wavelet.read(spark, f"{tmp_path}/none").count() == 0


PAGES = {
    "<html><body><header><h1>Site</h1></header><div id='cookie-notice'>Cookies</div><main><article><header><h1>Title</h1></header>"
    "<p>First paragraph &amp; more words of it.<p>Second,\n with   space.<ul><li>one<li>two</ul><div class='share'>Share</div></article>"
    "<section id='comments'><p>A very long comment of a reader that goes on and on, longer than the article.</p></section></main>"
    "<aside>Side</aside></body><footer>foot</footer></html>": "Title First paragraph & more words of it. Second, with space. one two",
    "<div class='menu'><a>1</a></div><div class='content with-sidebar'><p>Hello world, a page without an article.</p><p>Short.</p>"
    "<form><input><label>Name</label></form><p>More &#233;&nbsp;x</p></div><div class='sidebar'>no</div>": "Hello world, a page without an article. Short. More é x",
    "plain": "plain", "": "", "<p>abc <a hre": "abc", "<p>A < B</p>": "A < B", "<script>x": "",
    "<article><p>abc<script>var x='</p>'</script></article>": "abc",
}


def test_html(spark):
    given = [(i, None, html) for i, html in enumerate(PAGES)] + [(None, "u", None), (1, "u", "<p>" + "long " * 100_000)]
    pages = spark.createDataFrame([(*r, "t") for r in given], "page_id long, url string, html string, text string")
    found = html_text.extract(pages).collect()
    assert len(found) == len(given) and all(r.n_chars == len(r.text) for r in found)
    texts = collections.Counter(r.text for r in found)
    assert texts == collections.Counter([*PAGES.values(), "", ("long " * 100_000).strip()])
    assert html_text.extract(pages.limit(0)).count() == 0


def test_html_pages_by_their_article(spark, sf_dir):
    import html
    import re

    for r in html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).join(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())


def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == names and 0 < docs.count()
    assert docs.count() == before.count()


def test_pipeline_runs_its_stages_in_a_row(spark, sf_dir, monkeypatch):
    stages = [("few", lambda _, docs, __: docs.filter("doc_id < 5")), ("ids", lambda _, docs, __: docs.select("doc_id"))]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()) == [0, 1, 2, 3, 4]


def test_ten_operators_are_registered():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 11))
