"""Line rules, blocks with zone maps, and alignment of two tokenizers: SQL, brute force, odd tables."""

import collections
import hashlib
import itertools
import time

import duckdb
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from asfalto.llm import line_rules, span_links, zone_blocks
from asfalto.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL
from tools.check_oracles import compare

SCHEMA = "doc_id long, text string, n_words long, kept string, chunk long, place int, m string, _m0 int"
SENTENCE = "The committee met on Tuesday and agreed on the plan for the coming year. "


def table(spark, texts):
    rows = [(i, t, 0, "x", 0, 0, "y", 1) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def small():
    con = duckdb.connect()
    for name in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op11_line_rules", "op12_zone_blocks"])
def test_query_against_sql(spark, small, name):
    assert compare(QUERIES[name](spark, SMALL), small, ORACLES[name]).startswith("ok")


# --- 11

PROSE = "\n".join(f"Paragraph {n} says that item {n * 7} was seen near gate {n * 3} on day {n}." for n in range(12))
ODD_TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, PROSE), (4, PROSE), (5, SENTENCE * 5000), (None, "no id"),
    (6, "Home | News | Sport | Login\n" + PROSE), (7, "a" * 300_000), (8, "* " * 3000), (9, "x\n" * 200),
    (10, "| "), (11, "é日本 \x0b\x0c\r ✓." * 20), (12, "--" * 100_000), (13, ".\"" * 100_000),
]


def test_line_rules_of_odd_tables(spark):
    rows = {(r.doc_id, n): r for n, r in enumerate(line_rules.judged(table(spark, ODD_TEXTS).coalesce(1)).collect())}
    kept = {i for (i, _), r in rows.items() if r.kept}
    assert kept == {4, 6}
    assert all(rows[n + 1, n].n_words == 0 and rows[n + 1, n].base_failed for n in range(3))
    assert rows[5, 5].n_repeat_words == rows[5, 5].n_words == 14 * 5000
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", ODD_TEXTS)
    got = line_rules.judged(table(spark, ODD_TEXTS)).drop("lost_chars")
    assert compare(got, con, ORACLES["op11_line_rules"]).startswith("ok")
    assert line_rules.judged(table(spark, [])).count() == 0


@pytest.mark.parametrize("line, rule", [
    ("", None), ("   \t", None), ("A short sentence that ends.", None), ("He said \"Stop!\"", None),
    ("Home | News | Sport | Weather", "navigation"), ("Start › Shop › Shoes", "navigation"),
    ("price$$$ of### the%%% day", "symbols"), ("BUY!! NOW!! CHEAP!!", "cries"),
    ("We use cookies to improve this site.", "boilerplate"), ("All rights reserved.", "boilerplate"),
    ("Latest headlines", "punctuation"), (SENTENCE * 4 + "cookie policy " * 3 + SENTENCE, None),
])
def test_rule_of_a_line(spark, line, rule):
    assert spark.createDataFrame([(line,)], "line string").select(line_rules.fails(F.col("line"))).first()[0] == rule


def test_clean_takes_out_lines_and_rejects(spark):
    most = "\n".join(["Menu | Home | Contact | More | Help | Top | Map | Jobs"] * 40)
    texts = [(1, "Latest headlines\n" + PROSE + "\nShare this page with a friend."), (2, PROSE + "\n" + most)]
    rows = line_rules.clean(table(spark, texts)).collect()
    assert [(r.doc_id, r.text, r._m0, r.n_words, r.kept) for r in rows] == [(1, PROSE, 1, 0, "x")]


def test_line_rules_need_no_python(spark):
    plan = line_rules.judged(table(spark, ODD_TEXTS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- 12


def mined_plainly(rows, positives=5, negatives=10):
    """Of (vec_id, embedding, label) with integer scores; ties by vec_id, then by order."""
    v = np.floor(256 * np.array([r[1] for r in rows], np.float64)).astype(np.int64)
    ids, labels = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    found = []
    for a in np.flatnonzero(ids % 100 == 0):
        scores = v @ v[a]
        order = np.lexsort((ids, -scores))
        for x in [x for x in order if labels[x] == labels[a] and x != a][:positives]:
            far = [y for y in order if labels[y] != labels[a] and 30 * scores[x] <= 100 * scores[y] <= 90 * scores[x]]
            found += [(int(ids[a]), int(ids[x]), k, int(ids[y]), int(scores[x]), int(scores[y]))
                      for k, y in enumerate(far[:negatives], 1)]
    return sorted(found)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node long, pack long").repartition(4)


def mined(df, **sizes):
    return sorted(map(tuple, zone_blocks.mine(df, F.col("vec_id") % 100 == 0, F.col("label"), **sizes).collect()))


def test_curve_visits_neighbours():
    for dimensions, bits in ((1, 4), (2, 3), (3, 2), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
        place = zone_blocks.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_intervals_hold_every_score():
    rng = np.random.default_rng(3)
    anchors, rows = rng.integers(-300, 300, (20, 8)), rng.integers(-300, 300, (30, 50, 8))
    least, greatest = zone_blocks.intervals(anchors, rows.min(axis=1), rows.max(axis=1))
    scores = np.einsum("ad,znd->azn", anchors, rows)
    assert (least <= scores.min(axis=2)).all() and (scores.max(axis=2) <= greatest).all()


def test_products_of_large_integers_are_exact():
    rng = np.random.default_rng(4)
    a, b = rng.integers(-(1 << 27), 1 << 27, (5, 3)), rng.integers(-(1 << 27), 1 << 27, (7, 3))
    assert zone_blocks.products(a, b).tolist() == (a.astype(object) @ b.astype(object).T).tolist()


def test_mining_of_odd_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1, 9, 9), (1, [1.0, 0.4], 1, 9, 9), (1, [1.0, 0.4], 1, 9, 9), (2, [0.5, 0.1], 2, 9, 9),
            (3, [0.5, 0.1], 2, 9, 9), (3, [0.5, 0.1], 2, 9, 9), (4, [0.0, 0.0], 2, 9, 9), (100, [0.0, 0.0], 1, 9, 9),
            (200, [-1.0, 0.3], 3, 9, 9), (5, [0.9, 0.1], 2, 9, 9)]
    absent = [(300, None, 1, 9, 9), (6, [1.0, None], 1, 9, 9), (7, [nan, 1.0], 2, 9, 9), (8, [inf, 1.0], 2, 9, 9),
              (9, [1.0, 1.0], None, 9, 9), (10, [1.0], 2, 9, 9), (11, [1e30, 1.0], 2, 9, 9), (12, [], 2, 9, 9)]
    assert mined(vectors(spark, rows + absent)) == mined_plainly(rows)
    assert mined(vectors(spark, rows + absent), block_rows=2, pack_rows=1, sample_rows=3) == mined_plainly(rows)
    assert mined(vectors(spark, [])) == []
    assert mined(vectors(spark, [(1, [1.0, 2.0], 1, 0, 0)])) == []


@pytest.fixture(scope="module")
def clustered():
    """Forty tight groups, some labels within one group, one label with a third of the rows, copies."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    own = rng.integers(0, 40, 6000)
    rows = (centres[own] + 0.05 * rng.normal(size=(6000, 16))).astype(np.float32)
    rows[1000:1100] = rows[1000]
    labels = np.where(rng.random(6000) < 1 / 3, 99, own // 2)
    return [(n, rows[n].tolist(), int(labels[n]), 0, 0) for n in range(6000)]


def test_mining_of_clustered_rows_reads_few_blocks(spark, clustered, monkeypatch):
    chosen = []
    plain = zone_blocks.chosen_blocks

    def counted(*args, **more):
        found = plain(*args, **more)
        chosen.append(found.count())
        return found

    monkeypatch.setattr(zone_blocks, "chosen_blocks", counted)
    got = mined(vectors(spark, clustered), block_rows=64, pack_rows=1)
    assert got == mined_plainly(clustered)
    blocks, packs = 6000 / 64, 60
    # rows of the best few blocks, then of those that still meet a window: for positives, then for negatives
    assert chosen[0] + chosen[1] < 0.3 * blocks * packs and chosen[3] < 0.7 * blocks * packs


# --- 13

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def aligned_plainly(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first, second, table = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), span_links.byte_level()
    first.encode_special_tokens = True
    documents, counts = [], collections.Counter()
    for text in texts:
        a = first.encode(f" {text or ''}", add_special_tokens=False).ids
        b = second.encode(text or "")
        a_bytes = [bytes(table[c] for c in first.id_to_token(i)) for i in a]
        pieces = [second.id_to_piece(i) for i in b]
        b_bytes = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in zip(b, pieces)]
        whole = f" {text}".encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            documents.append(([], [], [], []))
            continue
        owner = [[n for n, x in enumerate(side) for _ in x] for side in (a_bytes, b_bytes)]
        links = [(a[x], b[y]) for x, y in dict.fromkeys(zip(*owner))]
        ends = [list(itertools.accumulate(map(len, side))) for side in (a_bytes, b_bytes)]
        cuts, groups, x, y = sorted(set(ends[0]) & set(ends[1])), [], 0, 0
        for cut in cuts:
            u, w = ends[0].index(cut, x) + 1, ends[1].index(cut, y) + 1
            groups.append(",".join(map(str, a[x:u])) + "|" + ",".join(map(str, b[y:w])))
            x, y = u, w
        counts.update(links)
        documents.append((a, b, groups, links))
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (len(a), len(b), len(groups), len(links), sum(counts[k] == best[k[1]] for k in links),
         sum(counts[k] for k in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
        for a, b, groups, links in documents
    ]


def as_rows(ids, values):
    return collections.Counter((i, *v) for i, v in zip(ids, values))


def test_alignment_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = as_rows([r.doc_id for r in docs], aligned_plainly([r.text for r in docs]))
    assert collections.Counter(map(tuple, QUERIES["op13_span_links"](spark, SMALL).collect())) == want


def test_alignment_of_odd_tables(spark):
    texts = [(1, None), (2, ""), (3, " "), (4, "two  spaces\n"), (5, "a <|endoftext|> b <s> </s> <unk>"), (6, "é日本 ✓ x▁y"),
             (7, "the cat sat"), (7, "the cat sat"), (None, "the cat"), (8, "x" * 20_000), (9, SENTENCE * 2000),
             (10, "tab\tand\rreturn"), (11, "ｆｕｌｌ width"), (12, "zero\x00byte")]
    want = as_rows([i for i, _ in texts], aligned_plainly([t for _, t in texts]))
    for bounds in ({}, {"chunk_pairs": 10, "chunk_links": 10}):
        got = span_links.aligned(table(spark, texts).repartition(5), A, B, **bounds).collect()
        assert collections.Counter(map(tuple, got)) == want
    assert span_links.aligned(table(spark, []), A, B).count() == 0


def test_words_encoded_once_are_words_of_whole_texts():
    """Odd white space, marks that join, and words of many kinds, with a small store of words."""
    rng = np.random.default_rng(6)
    bits = ["a", "don't", "x1", "42", "é", "e\u0301", "日本", "\u0301", "\n", "\t", " ", "  ", "\u00a0", "\u3000", "\u0085", "\x1c",
            "...", "'s", "<|endoftext|>", "▁", "\u200b", "😀", "\ufeff", "ﬁ", "½"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 12))) for _ in range(4000)]
    texts += [" ".join(rng.choice(bits, rng.integers(1, 6))) for _ in range(4000)]
    sides = span_links.Sides(span_links.byte_side(A), span_links.piece_side(B))
    for part in (texts[:3000], texts[3000:]):
        for side, (ids, offsets) in zip((sides.a, sides.b), sides.encode(pa.array(part))):
            whole = side.encode(part)
            for n, text in enumerate(part):
                assert ids[offsets[n] : offsets[n + 1]].tolist() == (whole[n] if text else []), repr(text)


def test_words_are_aligned_once(monkeypatch):
    """A word met before costs no alignment; the documents are as if each were aligned whole, also after forgetting."""
    aligned, overlaps = [0], span_links.overlaps

    def counted(a, b):
        aligned[0] += len(a)
        return overlaps(a, b)

    monkeypatch.setattr(span_links, "overlaps", counted)
    rng = np.random.default_rng(13)
    bits = ["un", "believ", "able", "é", "日本", "'s", "42", "\n", "...", "✓"]
    words = {"".join(rng.choice(bits, rng.integers(1, 5))).strip() or "x" for _ in range(300)}
    words = sorted(w for w in words if "\n\n" not in w)  # which would make a text one that is aligned whole
    texts = [" ".join(rng.choice(words, rng.integers(1, 40))) for _ in range(600)]
    odd = ["", " ", "two  spaces", "x▁y", "end ", " <s> </s>"]

    def of(sides, texts):
        part = span_links.align(list(range(len(texts))), pa.array(texts), sides)
        owner = np.repeat(np.arange(len(texts)), part.sizes)
        n_links = np.bincount(owner, part.repeats, len(texts)).astype(int)
        return list(zip(part.n_a, part.n_b, part.n_groups, n_links, part.hashes))

    def wanted(texts):
        return [(*row[:4], row[6]) for row in aligned_plainly(texts)]

    sides = span_links.Sides(span_links.byte_side(A), span_links.piece_side(B))
    first, again = of(sides, texts), [of(sides, texts[n : n + 100]) for n in range(0, len(texts), 100)]
    assert first == sum(again, []) == wanted(texts)
    tokens = sum(row[0] for row in first)
    assert aligned[0] < tokens / 5
    monkeypatch.setattr(span_links, "MOST_WORDS", 50)
    for n in range(0, len(texts), 100):
        assert of(sides, texts[n : n + 100] + odd) == wanted(texts[n : n + 100] + odd)


def test_words_whose_tokens_have_other_bytes_are_cut_right():
    def dropping(texts):
        return [[" ab".index(c) for c in f" {text}" if c != "!"] for text in texts]

    side = span_links.Side([b" ", b"a", b"b"], dropping, True)
    for words in (["ab", "a", "b"], ["a!", "ab", "!b", "a"], ["a", "ab!"], []):
        ids, offsets = side.encode_words(words)
        assert [ids[x:y].tolist() for x, y in itertools.pairwise(offsets)] == dropping(words)


def test_alignment_is_linear_in_the_text(spark):
    start = time.monotonic()
    assert span_links.aligned(table(spark, [(1, SENTENCE * 20_000)]), A, B).first().n_a > 250_000
    assert time.monotonic() - start < 60
