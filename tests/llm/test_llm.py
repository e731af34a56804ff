"""The ten operators and the pipeline: against brute force, and on odd tables."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from asfalto.llm import (
    components, direct_codes, itq, kmeans_tree, kneser_ney, prefix_bpe, quality_pu, secret_cnn, sorted_hash,
    swap_packing, tag_paths, weighted_minhash,
)
from asfalto.llm.queries import ORACLES, QUERIES
from asfalto.session import new_folder
from tests.conftest import SMALL

WORDS, BYTES = P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, node long, score double"
LONG = "word and another one, " * 4000
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "One two three four five six seven."), (5, LONG), (5, LONG),
       (6, "password = \"abcdefgh12345678\" é日本"), (7, "x"), (None, "a row without an id"), (4, "Tie of an id")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and extra columns with clashing names."""
    rows = [(i, t, None, None, None if t is None else len(t), 1, 2, 0.5) for i, t in ODD]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(small):
    return {r.doc_id: r.text or "" for r in small.select("doc_id", "text").collect()}


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# --- 1


def test_codes_give_back_any_numbers():
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0), np.array([0, 255, 256, 65535, 65536, 2**32 - 1]), rng.integers(0, 49408, 5000)):
        ids = ids.astype(np.uint32)
        packed = direct_codes.DirectCodes(direct_codes.pack(ids))
        assert (packed.all() == ids).all()
        assert [packed[i] for i in range(0, len(ids), 7)] == ids[::7].tolist()


def test_token_files(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op1_token_files"](spark, SMALL).collect()}
    codec, before = tokenizer(), 0
    for doc_id in sorted(texts):
        ids = codec.encode(texts[doc_id], add_special_tokens=False).ids + [2]
        assert (got[doc_id].start, got[doc_id].n_tokens, got[doc_id].ids_crc32) == (before, len(ids), crc(ids))
        before += len(ids)


def test_token_files_of_odd_tables(spark, odd, empty):
    path = new_folder(spark, "odd")
    direct_codes.write_token_files(odd, path, WORDS, 2, segment_tokens=100)
    rows = direct_codes.read_token_files(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 4, 5, 5, 6, 7]
    assert [r.n_tokens for r in rows][1:4] == [1, 1, 1]
    first = rows[0]
    assert direct_codes.token_at(spark, path, first.shard, 0) == tokenizer().encode("a").ids[0]
    path = new_folder(spark, "none")
    direct_codes.write_token_files(empty, path, WORDS, 2)
    assert direct_codes.read_token_files(spark, path).count() == 0


# --- 2 and 5


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, node long, leaf string")


ODD_VECTORS = [(1, None, 0, "a"), (2, [0.0] * 4, 0, "a"), (3, [1.0, None, 0.0, 0.0], 0, "a"),
               (4, [float("nan")] * 4, 0, "a"), (5, [1.0, 2.0], 0, "a"), (6, [1.0, 0.0, 0.0, 0.0], 0, "a"),
               (7, [2.0, 0.0, 0.0, 0.0], 0, "a"), (7, [2.0, 0.0, 0.0, 0.0], 0, "a"), (50, [1.0, 0.0, 0.0, 0.0], 1, "b"),
               (8, [0.0, 1.0, 0.0, 0.0], 1, "b"), (9, [0.0, 0.99, 0.05, 0.0], 1, "b")]


def test_near_vectors_of_odd_tables(spark):
    got = sorted(tuple(r) for r in itq.near_vectors(vectors(spark, ODD_VECTORS)).collect())
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5)]
    assert got == sorted(alone + [(6, 3, 6, True), (7, 3, 6, False), (7, 3, 6, False), (50, 3, 6, False),
                                  (8, 1, 8, True), (9, 1, 8, False)])
    assert itq.near_vectors(vectors(spark, [])).count() == 0


def test_nearest_of_odd_tables(spark):
    found = kmeans_tree.nearest(vectors(spark, ODD_VECTORS), F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    assert [(r.vec_id, r["rank"]) for r in found] == [(6, 1), (7, 2), (7, 3), (8, 4), (9, 5)]
    assert [round(r.score, 6) for r in found] == [1, 1, 1, 0, 0]
    assert kmeans_tree.nearest(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def test_vectors_against_brute_force(spark):
    path = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{path}/embeddings.parquet").orderBy("vec_id").toPandas()
    e = np.array(rows.embedding.tolist(), float)
    u = e / np.linalg.norm(e, axis=1, keepdims=True)
    near = u @ u.T
    np.fill_diagonal(near, -2)
    ids = rows.vec_id.to_numpy()
    found = QUERIES["op2_kmeans_tree"](spark, path).collect()
    true = {(int(ids[q]), int(ids[n])) for q in np.flatnonzero(ids % 50 == 0) for n in np.argsort(-near[q])[:5]}
    assert len(true & {(r.query_id, r.vec_id) for r in found}) >= 0.9 * len(true)
    at = {v: n for n, v in enumerate(ids)}
    assert all(abs(r.score - near[at[r.query_id], at[r.vec_id]]) < 1e-12 for r in found)


# --- 3


def test_kneser_ney_against_brute_force(spark, small, texts):
    def tokens(text):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]

    train = [tokens(t) for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    single = collections.Counter(w for t in train for w in t)
    n, v = sum(single.values()), len(single)
    pairs = collections.Counter(p for t in train for p in zip(["<s> "] + t, t))
    after = collections.defaultdict(list)
    for (a, _), c in pairs.items():
        after[a].append(c)
    follows = collections.Counter(b for _, b in pairs)
    of = lambda values: kneser_ney.discounts([sum(x == k for x in values) for k in (1, 2, 3, 4)])
    d2, d1 = of(pairs.values()), of(follows.values())
    rest = sum(d1[min(f, 3) - 1] for f in follows.values()) / len(pairs)

    def p1(w):
        return (follows[w] - d1[min(follows[w], 3) - 1] if w in follows else 0) / len(pairs) + rest / (v + 1)

    def p(w, before):
        if before not in after:
            return p1(w)
        c = pairs.get((before, w), 0)
        spread = sum(d2[min(x, 3) - 1] for x in after[before])
        return ((c - d2[min(c, 3) - 1] if c else 0) + spread * p1(w)) / sum(after[before])

    assert abs(sum(p(w, "the") for w in [*single, "unknown word"]) - 1) < 1e-9
    model = kneser_ney.train(small.where(~kneser_ney.held_out(F.col("doc_id"))), shard_bytes=40_000)
    assert model.shards > 1 and (model.tokens, model.words) == (n, v)
    for r in kneser_ney.score(small, model).collect()[:60]:
        t = tokens(texts[r.doc_id])
        assert r.n_tokens == len(t) and r.train_tokens == n and r.n_known == sum(w in single for w in t)
        assert math.isclose(r.base_score, sum(math.log10((single[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        assert math.isclose(r.score, sum(math.log10(p(w, b)) for b, w in zip(["<s> "] + t, t)), rel_tol=1e-9)


def test_kneser_ney_of_odd_tables(spark, odd, empty):
    rows = kneser_ney.score(odd, kneser_ney.train(odd)).collect()
    assert len(rows) == len(ODD) and all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    nothing = kneser_ney.train(empty)
    assert nothing.tokens == 0 and kneser_ney.score(empty, nothing).count() == 0
    assert {r.n_known for r in kneser_ney.score(odd, nothing).collect()} == {0}


def test_hashes_and_packed_counts():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**64, 3000, dtype=np.uint64))
    assert (sorted_hash.unmix(sorted_hash.mix(keys)) == keys).all()
    back, counts = sorted_hash.unpack(sorted_hash.pack(keys, np.arange(len(keys))))
    assert (back == keys).all() and (counts == np.arange(len(keys))).all()
    assert len(sorted_hash.merged([])[0]) == 0


# --- 4

PAGE = """<html><head><title>x</title></head><body><header><h1>Site</h1><p>Tagline of it, here.</p></header>
<div id="menu"><a href=1>One</a> <a href=2>Two</a></div><div class="cookie-notice"><p>We use cookies, a lot.</p></div>
<div class="wrap"><div class="content"><h2>Title</h2><p>First part, with text. It goes
 on.<p>Unclosed, and <b>bold<br>text.<ul><li>one<li>item two is long, yes.</ul><div class="ad-box">Buy, now.</div>
<p>Caf&eacute; &amp; more&nbsp; with a <a href=x>link</a>, and text.</p><form><p>Name, please.</p></form></div>
<div class=sidebar><p>Side text that is long, and has commas, too.</p></div></div>
<section id="comments"><p>Great article, I liked it very much, thanks!</p></section><script>var a = "</p>";</script>
<footer>c 2020</footer></body></html>"""


def test_main_text():
    assert tag_paths.main_text(PAGE).split("\n\n") == [
        "Title", "First part, with text. It goes on.", "Unclosed, and bold text.", "one", "item two is long, yes.",
        "Café & more with a link, and text.",
    ]
    for page in ("", "<", "<p", "<p class='x", "text", "<!-- a", "<script>x", "</p></div>", "&amp &am;", "<div>" * 900):
        assert isinstance(tag_paths.main_text(page), str)
    assert tag_paths.main_text("<article><h1>Head</h1><p>Body, of it.") == "Head\n\nBody, of it."


def test_pages(spark):
    import html

    def plain(page):
        inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inner)
        bare = [re.sub(r"<[^>]*>?", lambda m: " " if "br" in m[0] else "", b) for b in blocks]
        return "\n\n".join(t for b in bare if (t := " ".join(html.unescape(b).split())))

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = QUERIES["op4_tag_paths"](spark, SMALL).collect()
    assert len(rows) == len(pages)
    assert all(r.text == plain(pages[r.page_id]) and r.n_chars == len(r.text) for r in rows)
    odd = spark.createDataFrame([(1, None, None, 0), (None, "u", "", 1), (2, "u", PAGE, 2), (2, "u", PAGE, 2)],
                                "page_id long, url string, html string, text int")
    assert sorted(r.n_chars for r in tag_paths.extract(odd).collect())[:2] == [0, 0]
    assert tag_paths.extract(odd.limit(0)).count() == 0


# --- 6


def test_packing(spark, texts):
    rows = QUERIES["op6_swap_packing"](spark, SMALL).collect()
    codec, by_doc, by_sequence = tokenizer(), collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = codec.encode(texts[doc_id], add_special_tokens=False).ids + [0]
        pieces.sort(key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in pieces] == [(n, 2048 * n) for n in range(len(pieces))]
        assert [(r.length, r.ids_crc32) for r in pieces] == [
            (len(ids[a : a + 2048]), crc(ids[a : a + 2048])) for a in range(0, len(ids), 2048)
        ]
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(by_sequence) <= 1.02 * -(-sum(r.length for r in rows) // 2048) + 1


def test_packing_of_odd_tables(odd, empty):
    rows = swap_packing.pack_documents(odd, WORDS, 0, group_pieces=3).collect()
    assert sum(r.piece == 0 for r in rows) == len(ODD) and sum(r.length == 1 for r in rows) >= 3
    assert swap_packing.pack_documents(empty, WORDS, 0).count() == 0


def test_packing_keeps_large_ids_beside_null(spark):
    ids = [9007199254740993, 9007199254740995, None, -(1 << 62) - 1]
    docs = spark.createDataFrame([(i, "a few words of text") for i in ids], "doc_id long, text string")
    found = swap_packing.pack_documents(docs, WORDS, end_id=0, group_pieces=100).collect()
    assert sorted((r.doc_id for r in found), key=str) == sorted(ids, key=str)


def test_special_strings_are_the_librarys(spark):
    texts = ["a <|endoftext|> b", "x<|startoftext|><|endoftext|>", "<|ENDOFTEXT|> c", "plain", "", "<|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    path = new_folder(spark, "special")
    direct_codes.write_token_files(docs, path, WORDS, 2)
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in direct_codes.read_token_files(spark, path).collect()}
    wanted = [tokenizer().encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert wanted[0] == [320, 49407, 321, 2]
    assert got == {n: (len(ids), crc(ids)) for n, ids in enumerate(wanted)}


def test_local_search_empties_bins():
    lengths = [6, 6, 4, 4, 5, 5]
    search = swap_packing._Search([[0], [1], [2, 4], [3, 5]], lengths, 10)
    search.run(5)
    bins = [sorted(lengths[i] for i in b) for b in search.bins if b]
    assert sorted(map(sum, bins)) == [10, 10, 10] and sorted(sum(search.bins, [])) == list(range(6))


# --- 7


def test_near_duplicates_agree_with_sql(spark):
    path = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    expected = {(a, b, c) for a, b, c in con.sql(ORACLES["op7_weighted_minhash"]).fetchall()}
    assert {tuple(r) for r in QUERIES["op7_weighted_minhash"](spark, path).collect()} == expected


def test_near_duplicates_of_odd_tables(spark, odd, empty):
    rows = sorted(map(tuple, weighted_minhash.classes(odd).collect()), key=str)
    assert len(rows) == len(ODD) and all(i == c and k for i, c, k in rows)
    kept = weighted_minhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 5").count() == 1
    assert weighted_minhash.classes(empty).count() == 0 and weighted_minhash.keep_one(empty).count() == 0


def test_dense_groups_stay_whole(spark):
    """A chain of copies, each of which is near to its neighbours only, is one class."""
    rng = np.random.default_rng(3)
    words, rows = [f"w{i}" for i in rng.integers(0, 10**6, 300)], []
    for n in range(40):
        rows.append((n, " ".join(words)))
        words[(n * 7) % 300] = f"new{n}"
    rows += [(100 + n, " ".join(f"u{n}x{i}" for i in range(50))) for n in range(5)]
    found = dict((r.doc_id, r.class_id) for r in weighted_minhash.classes(
        spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert {found[n] for n in range(40)} == {0} and all(found[100 + n] == 100 + n for n in range(5))


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(40, 30), (30, 30), (41, 40)], "a long, b long")
    found = dict(map(tuple, components.components(edges).collect()))
    assert found == {**dict.fromkeys(range(21), 0), 30: 30, 40: 30, 41: 30}
    assert components.components(edges.limit(0)).count() == 0


# --- 8


def test_base_spans(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op8_secret_cnn"](spark, SMALL).collect()}
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
    for doc_id, text in texts.items():
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        line = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        r = got[doc_id]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in spans) for n in range(3))
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_network_learns_and_keeps_recall():
    rng = np.random.default_rng(0)
    secret = ["".join(rng.choice(list("0123456789abcdef"), 40)) for _ in range(300)]
    other = [f"mail{n}.example.com" for n in range(300)]
    codes = [secret_cnn.window(f"some text {s} goes on", 10, 10 + len(s)) for s in secret + other]
    labels = np.array([1.0] * 300 + [0.0] * 300, np.float32)
    network = secret_cnn.fit(np.stack(codes), labels)
    yes = network.probabilities(np.stack(codes)) >= network.threshold
    assert yes[:300].mean() >= 0.95 and yes[300:].mean() <= 0.05
    assert secret_cnn.fit(np.stack(codes[:5]), labels[:5]) is None


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(1)
    network = secret_cnn.Network.start(2, width=3, filters=4)
    network.embedding, network.filters, network.filter_bias, network.out, network.out_bias = (
        w.astype(np.float64) for w in network.weights)
    codes = rng.integers(0, secret_cnn.SYMBOLS, (6, secret_cnn.LENGTH)).astype(np.uint8)
    labels = rng.integers(0, 2, 6).astype(np.float64)

    def loss():
        logits = network.logits(codes).astype(np.float64)
        return float(np.mean(np.logaddexp(0, logits) - labels * logits))

    for weights, gradient in zip(network.weights, network.gradients(codes, labels)):
        flat, found = weights.reshape(-1), gradient.reshape(-1)
        for n in rng.choice(flat.size, min(25, flat.size), replace=False):
            kept = flat[n]
            flat[n] = kept + 1e-5
            above = loss()
            flat[n] = kept - 1e-5
            below = loss()
            flat[n] = kept
            assert abs((above - below) / 2e-5 - found[n]) < 1e-4


def test_windows_take_in_all_of_a_candidate():
    text = "x " + "".join(chr(65 + n % 26) for n in range(133)) + " y"
    codes = list(secret_cnn.windows(text, 2, 135))
    inner = [c[secret_cnn.BEFORE : secret_cnn.BEFORE + secret_cnn.WITHIN] for c in codes]
    assert len(codes) == 6 and all((w > 0).all() for w in inner)
    whole = secret_cnn.window(text, 95, 135)
    assert (codes[-1] == whole).all()
    assert len(list(secret_cnn.windows(text, 2, 14))) == 1


def test_secrets_past_the_first_window_and_without_digits(spark):
    """Words of twelve letters are candidates that the network turns down; a late or letters-only secret is not lost."""
    rng = np.random.default_rng(4)
    pick = lambda letters, n: "".join(rng.choice(list(letters), n))
    rows = []
    for n in range(400):
        words = " ".join(pick("aeioulnrst", 13) for _ in range(6))
        rows.append((n, f"{words} key {pick('0123456789abcdef', 40)} {words} password: {pick('QWXZKJV', 24)} end"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    network = secret_cnn.train(docs)
    assert network.recall >= secret_cnn.RECALL - 0.02
    late = f"{'lorentinasel' * 5}{pick('QWXZKJV', 40)}"
    text = f"see {late} and {pick('QWXZKJV', 30)} but not internationalisation {pick('aeioulnrst', 13)} here"
    (row,) = secret_cnn.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), network).collect()
    spans = [tuple(map(int, s.split(":")[1:])) for s in row.spans.split(",")]
    found = [text[a:b] for a, b in spans]
    assert late in found and len(found) == 2 and "internationalisation" not in found


def test_network_learns_from_every_document(spark):
    """Findings of all documents are counted, and those dealt over several tasks give a network that works."""
    rng = np.random.default_rng(4)
    hexes = ["".join(rng.choice(list("0123456789abcdef"), 32)) for _ in range(600)]
    texts = [f"note {n}: {h} and then extraordinary number {n}-{n * 7919 + 10**11} follows" for n, h in enumerate(hexes)]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts + texts[:50])], "doc_id long, text string")
    sums = {r.kind: r.n for r in secret_cnn.findings(docs).groupBy("kind").sum("n").toDF("kind", "n").collect()}
    assert sums == {secret_cnn._SECRET: 650, secret_cnn._PLAIN: 650, secret_cnn._NUMBERED: 650}
    network = secret_cnn.train(docs, share=500)
    assert network.recall >= secret_cnn.RECALL
    text = "note 9: " + "0a1b2c3d4e5f" * 3 + " and then extraordinary number follows"
    (row,) = secret_cnn.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), network).collect()
    assert "model" not in row.spans


def test_secrets_of_odd_tables(odd, empty):
    rows = secret_cnn.scan(odd, secret_cnn.train(odd)).collect()
    assert len(rows) == len(ODD) and [r.spans for r in rows if r.doc_id == 6] == ["assign:0:28"]
    blank = {r.doc_id: r for r in secret_cnn.redact(odd, None, length_column="n_chars").where("doc_id in (1, 6)").collect()}
    assert blank[6].text == '[SECRET]" é日本' and blank[6].n_chars == 13 and blank[1].text is None
    assert secret_cnn.scan(empty, secret_cnn.train(empty)).count() == 0
    assert secret_cnn.blanked("abcdefgh", [(1, 0, 4), (3, 2, 6)], "#") == "a#gh"


# --- 9


def test_quality_on_held_out_labels(spark):
    path = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    rows = QUERIES["op9_quality_pu"](spark, path).join(labels, "doc_id").where("held_out").toPandas()
    good, bad = rows[rows.quality == 1].score.to_numpy(), rows[rows.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.98
    assert (good >= 0.3).mean() > 0.99 and (bad < 0.3).mean() > 0.7
    assert ((rows.score >= 0.3).astype(int) == rows.predicted).all()


@pytest.mark.parametrize("trusted, others", [(1, 6), (2, 1), (1, 0)])
def test_quality_with_hardly_any_text(spark, trusted, others):
    """Fold 0 is never learned from, so ids outside it are chosen."""
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5][: trusted + others]
    docs = spark.createDataFrame([(i, f"Some text number {i}.") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(n < trusted)) for n, i in enumerate(ids)], "doc_id long, quality int")
    scores = quality_pu.score_documents(docs, quality_pu.train(docs, labels)).collect()
    assert len(scores) == len(ids) and all(0 <= r.score <= 1 for r in scores)


def test_stages_leave_clashing_columns_alone(spark):
    schema = "doc_id long, text string, n_chars long, _kept_id string, _new_text string, _measures string"
    rows = [(1, "password = abcdefgh12345678", 27, "a", "b", "c"), (2, "plain words", 11, "a", "b", "c")]
    docs = spark.createDataFrame(rows, schema)
    assert sorted(map(tuple, weighted_minhash.keep_one(docs).collect())) == rows
    changed = sorted(map(tuple, secret_cnn.redact(docs, None, length_column="n_chars").collect()))
    assert changed[1] == rows[1] and changed[0][3:] == rows[0][3:] and "abcdefgh" not in changed[0][1]


def test_quality_of_odd_tables(spark, odd, empty):
    labels = spark.createDataFrame([(6, 1, 0), (7, 1, 1), (5, 1, 0), (4, 0, 0), (None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality_pu.score_documents(odd, quality_pu.train(odd, labels)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    none = quality_pu.train(empty, labels.limit(0))
    assert none is None and quality_pu.score_documents(odd, none).where("predicted = 1").count() == len(ODD)
    assert quality_pu.score_documents(empty, None).count() == 0


# --- 10


@pytest.fixture(scope="module")
def codec():
    return prefix_bpe.text_codec(BYTES, P.PATTERN)


@pytest.fixture(scope="module")
def reference(codec):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.vocabulary.ranks, special_tokens={})


def test_prefix_encoding(spark, texts, codec, reference):
    for r in QUERIES["op10_prefix_bpe"](spark, SMALL).collect():
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_prefix_tables_append_and_edit(codec, reference):
    rng = np.random.default_rng(5)
    for _ in range(60):
        data = bytes(rng.choice(list(b"aeiounthers"), 150).tolist())
        table = prefix_bpe.PrefixTable(codec.vocabulary, data[:70])
        table.append(data[70:])
        assert table.tokens() == codec.vocabulary.encode(data)
        assert table.tokens(90) == codec.vocabulary.encode(data[:90])
        a, b = sorted(rng.integers(0, 150, 2).tolist())
        table.replace(a, b, b"th")
        edited = data[:a] + b"th" + data[b:]
        assert table.data == edited and table.tokens() == codec.vocabulary.encode(edited)
    text = "".join(rng.choice(list("ab é日0 \n\t'’s!"), 3000).tolist())
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_prefix_encoding_of_odd_tables(odd, empty):
    rows = prefix_bpe.encode_digests(odd, BYTES, P.PATTERN).collect()
    assert len(rows) == len(ODD) and {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert prefix_bpe.encode_digests(empty, BYTES, P.PATTERN).count() == 0


# --- pipeline


def test_pipeline_stages(spark, small):
    import corpus_pipeline

    docs, kept = small, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == small.columns
        docs.write.parquet(path := new_folder(spark, name))
        docs = spark.read.parquet(path)
        kept[name] = docs.count()
    classes = weighted_minhash.classes(small).where("kept").count()
    assert 0 < kept["near_duplicates"] == kept["secrets"] <= min(classes, kept["quality"])
    assert docs.where(F.col("text").rlike("AKIA[A-Z0-9]{14}")).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == kept["secrets"]


def test_pipeline_of_odd_tables(spark, odd, empty, tmp_path):
    """Nulls, empty and long texts, repeats and clashing columns go through every stage."""
    import corpus_pipeline

    spark.createDataFrame([(4, 1), (5, 1), (None, 1), (4, None)], "doc_id long, quality int").write.parquet(
        str(tmp_path / "labels.parquet"))
    for docs in (odd.withColumn("_kept_id", F.lit("a")).withColumn("_new_text", F.lit("b")), empty):
        given = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == given, name
            docs.write.parquet(path := new_folder(spark, name))
            docs = spark.read.parquet(path)
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_latin_words_are_cut_without_the_library():
    import pyarrow as pa
    import public_tokenizers

    from asfalto.llm import wordpiece

    codec = wordpiece.WordCodec(public_tokenizers.path("word_bpe_49k.json"))
    signs = [chr(n) for n in (*range(33, 127), *range(161, 256))]
    texts = ["Ação à ÉCOLE d'été ²½x ªb µº«", *(a + b + "s" for a in signs for b in signs[::7])]
    expected = [e.ids for e in codec._tokenizer.encode_batch(texts, add_special_tokens=False)]
    codec._normalizer = codec._pre = None  # as slow for a word as all the rest
    ids, offsets = codec.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == expected


def test_words_met_often_outlive_a_full_codec(monkeypatch):
    import pyarrow as pa
    import public_tokenizers

    from asfalto.llm import wordpiece

    monkeypatch.setattr(wordpiece, "MOST_WORDS", 40)
    monkeypatch.setattr(wordpiece, "MOST_PIECES", 10)
    codec = wordpiece.WordCodec(public_tokenizers.path("word_bpe_49k.json"))
    added = []
    insert = codec._add
    codec._add = lambda words: (added.extend(words), insert(words))
    for n in range(12):
        texts = ["often été 中文 here", " ".join(f"w{n}x{m}é" for m in range(15))]
        ids, offsets = codec.encode(pa.array(texts))
        expected = [e.ids for e in codec._tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == expected
    assert added.count("often") == 1 and len(codec._words) < 80
