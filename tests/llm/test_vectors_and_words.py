"""Spelling groups, top-k search and hard negatives against plain Python, and odd rows."""

import collections
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from entity360.llm import hard_negatives, spelling, vectors
from entity360.llm.hard_negatives import mine
from entity360.llm.queries import ORACLE_SQL, QUERIES
from entity360.llm.spelling import spelling_groups, word_counts
from entity360.llm.topk_search import nearest
from tests.llm.cases import FOLDER, documents, empty, messy, messy_rows, table_of


def _words(docs, every):
    counts = collections.Counter()
    for doc, text in docs:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), word)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if every and h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return counts


def _near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _groups(docs, every=97, least_length=5, least_count=3):
    n = {w: k for w, k in _words(docs, every).items() if k >= least_count and len(w) >= least_length}
    by_length = collections.defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if _near(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def _spelled(df, **options):
    found = spelling_groups(df, **options).select("word", "form", "root", "n", "n_near", "form_n")
    return {tuple(r) for r in found.collect()}


def test_spelling_query_agrees_with_all_pairs(spark):
    docs = [d for d in documents(spark)][:60]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = _spelled(table, drop_every=97, least_count=2)
    assert got == _groups(docs, least_count=2)
    assert any(n_near for *_, n_near, _ in got)


def test_spelling_query_counts_every_document(spark):
    got = QUERIES["op11_spelling_variants"](spark, FOLDER).select("word", "n")
    want = {(w, n) for w, n in _words(documents(spark), 97).items() if n >= 3 and len(w) >= 5}
    assert {tuple(r) for r in got.collect()} == want


def test_forms_lead_to_roots_over_several_steps(spark):
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbbb"]
    text = " ".join(w for i, w in enumerate(chain) for _ in range(3 * 2**i))
    got = {w: (form, root) for w, form, root, *_ in _spelled(spark.createDataFrame([(1, text)], "doc_id int, text string"))}
    assert got == {w: (f, "bbbbbb") for w, f in zip(chain, [*chain[1:], None], strict=True)}


def test_ties_go_to_the_smaller_word_and_short_or_rare_words_take_no_part(spark):
    text = "abcdx " * 3 + "abcda ABCDB abcdb abcda " * 5 + "abcd " * 9 + "abcdz " * 2
    got = _spelled(spark.createDataFrame([(1, text)], "doc_id int, text string"))
    assert got == {
        ("abcdx", "abcda", "abcda", 3, 2, 10),
        ("abcda", None, "abcda", 10, 2, None),
        ("abcdb", None, "abcdb", 10, 2, None),
    }


def test_blocks_of_a_hot_end_lose_and_repeat_nothing(spark, monkeypatch):
    random.seed(5)
    words = {"pre" + "".join(random.choices("abcñ", k=random.randint(3, 4))) for _ in range(150)}
    docs = [(i, " ".join(words)) for i in range(3)]
    table = spark.createDataFrame(docs, "doc_id int, text string")
    for name, size in (("HOT", 10), ("BUCKET", 16), ("LOOKING", 7)):
        monkeypatch.setattr(spelling, name, size)
    assert _spelled(table) == _groups(docs, every=None)


@pytest.mark.parametrize("words", [["ab", "abc", "b", "abd", "abcd", "xbc", "ac", "axc"], ["é" * 70, "é" * 69, "é" * 70 + "a"]])
def test_index_finds_what_is_one_edit_away(words):
    index = spelling.PositionIndex(words)
    for word in [*words, "zz"]:
        for shift in (-1, 0, 1):
            _, found = index.one_edit([word], shift)
            want = [i for i, w in enumerate(words) if len(w) == len(word) + shift and _near(w, word)]
            assert sorted(found.tolist()) == want


def test_words_of_odd_rows(spark):
    got = _spelled(messy(spark), drop_every=97, least_length=1, least_count=1)
    want = _words(messy_rows(), 97)
    assert {(w, n) for w, _, _, n, *_ in got} == {(w, n) for w, n in want.items()}
    assert _spelled(empty(spark), drop_every=97) == set()
    with pytest.raises(ValueError):
        spelling_groups(messy(spark), ratio=1)


def test_long_texts_are_cut_between_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 7)
    assert [w for words in spelling._words("one, twothree\nfourfivesix a") for w in words] == [
        "one", "twothree", "fourfivesix", "a"
    ]
    monkeypatch.undo()
    text = "abcdé " * 400_000
    got = word_counts(table_of(spark, [(1, text)]), "doc_id", "text").collect()
    assert [(r.word, r.n) for r in got] == [("abcdé", 400_000)]


VECTORS = "vec_id bigint, embedding array<float>, label int, row string, ID2 int, vector int, score int, part int"


def _vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows], VECTORS).repartition(3)


def _odd_vectors():
    random.seed(11)
    rows = [(i, [random.gauss(0, 1) for _ in range(9)], i % 3) for i in range(120)]
    rows += [(200 + i, [1.0, 0.5, -0.25] * 3, 1) for i in range(40)]  # many ties
    rows += [(150, [1.0, 0.5, -0.25] * 3, 1)] * 3 + [(100, None, 1), (50, [1.0, None], 1), (250, [math.nan], 0)]
    rows += [(None, [0.5] * 9, 1), (None, [0.5] * 9, None), (300, [math.inf] * 9, 1), (350, [], 1), (400, [2.0], 2)]
    return rows


def _plain(rows):
    """(vec_id, integer components, label) of the usable rows."""
    out = []
    for vec_id, vector, label in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            out.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    return out


def _ranked(rows, k):
    return sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0]))[:k]


def _dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def _nearest(rows, every, k):
    usable, out = _plain(rows), []
    for i, (query, vector, _) in enumerate(usable):
        if query is not None and query % every == 0:
            found = [(v, _dot(vector, w)) for j, (v, w, _) in enumerate(usable) if j != i]
            out += [(query, rank, v, s) for rank, (v, s) in enumerate(_ranked(found, k), 1)]
    return collections.Counter(out)


def _collected(df):
    return collections.Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("parts", [1, 2, 4, 20])
def test_search_agrees_with_all_pairs_whatever_the_blocks(spark, monkeypatch, parts):
    monkeypatch.setattr(vectors, "ROW_BLOCK", 37)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 5)
    got = nearest(_vectors(spark, _odd_vectors()), "id % 10 = 0", k=7, parts=parts)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert _collected(got) == _nearest(_odd_vectors(), 10, 7)


def test_search_returns_all_rows_where_there_are_fewer(spark):
    rows = _odd_vectors()[:4]
    assert _collected(nearest(_vectors(spark, rows), "id % 2 = 0", k=9)) == _nearest(rows, 2, 9)
    assert nearest(_vectors(spark, rows), "id = 77").count() == 0
    assert nearest(_vectors(spark, rows[:1]), "id % 2 = 0").count() == 0
    assert nearest(_vectors(spark, []), "id % 2 = 0").count() == 0


def test_large_components_stay_exact_and_too_large_ones_are_an_error(spark):
    rows = [(i, [3_001.5 + i, -8_003.25 * i, 0.004 + i], 0) for i in range(30)]
    assert _collected(nearest(_vectors(spark, rows), "id % 5 = 0")) == _nearest(rows, 5, 5)
    assert _collected(mine(_vectors(spark, rows), "id % 5 = 0")) == _mined(rows, 5)
    with pytest.raises(ValueError, match="64 bits"):
        nearest(_vectors(spark, rows + [(77, [1e30], 0)]), "id % 5 = 0")
    a = np.array([[2**26 + 1, 3]], np.int64)
    assert vectors.products(a, a, in_doubles=False)[0, 0] == (2**26 + 1) ** 2 + 9


def _mined(rows, every, positives=5, negatives=3):
    usable, out = [r for r in _plain(rows) if r[2] is not None], []
    for i, (anchor, vector, label) in enumerate(usable):
        if anchor is None or anchor % every:
            continue
        others = [(v, _dot(vector, w), other) for j, (v, w, other) in enumerate(usable) if j != i]
        for positive, best, _ in _ranked([r for r in others if r[2] == label], positives):
            fit = [r for r in others if r[2] != label and 50 * best <= 100 * r[1] <= 95 * best]
            out += [(anchor, positive, k, v, best, s) for k, (v, s, _) in enumerate(_ranked(fit, negatives), 1)]
    return collections.Counter(out)


@pytest.mark.parametrize("blocks", [(37, 5), (2_048, 1_024)])
def test_mining_agrees_with_all_pairs_whatever_the_blocks(spark, monkeypatch, blocks):
    monkeypatch.setattr(vectors, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(vectors, "QUERY_BLOCK", blocks[1])
    got = mine(_vectors(spark, _odd_vectors()), "id % 10 = 0")
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert _collected(got) == _mined(_odd_vectors(), 10)


def test_mining_of_few_rows(spark):
    rows = [(0, [1.0, 1.0], 0), (10, [1.0, 0.9], 0), (3, [0.7, 0.7], 1), (4, [-1.0, 0.0], 1)]
    assert _collected(mine(_vectors(spark, rows), "id % 10 = 0")) == _mined(rows, 10)
    assert mine(_vectors(spark, rows[2:]), "id % 10 = 0").count() == 0
    assert mine(_vectors(spark, []), "id % 10 = 0").count() == 0


def test_summaries_bound_every_product_at_every_level():
    random = np.random.default_rng(2)
    a, b = random.integers(-300, 300, (20, 13)), random.integers(-300, 300, (30, 13))
    a[3], b[4], b[5] = 7, 7, 0
    exact, (mean_a, dev_a), (mean_b, dev_b) = a @ b.T, hard_negatives.summaries(a), hard_negatives.summaries(b)
    at, width = 0, None
    for starts in hard_negatives.segments(13):
        level = slice(at, at + len(starts))
        middle, reach = mean_a[:, level] @ mean_b[:, level].T, dev_a[:, level] @ dev_b[:, level].T
        assert (np.abs(exact - middle) <= reach + 1e-6).all()
        assert width is None or reach.sum() < width
        at, width = at + len(starts), reach.sum()


@pytest.mark.parametrize("name", ["op12_topk_search", "op13_hard_negatives"])
def test_vector_queries_match_their_sql_on_odd_rows(spark, tmp_path, name):
    table = _vectors(spark, _odd_vectors()).select("vec_id", "embedding", "label")
    table.coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = QUERIES[name](spark, str(tmp_path))
    rel = con.sql(ORACLE_SQL[name])
    assert rel.columns == got.columns
    assert _collected(got) == collections.Counter(rel.fetchall())
