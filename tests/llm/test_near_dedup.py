"""Near-duplicate components against all pairs of a small table."""

import random
import re

import numpy as np
import pandas as pd

from entity360.llm import near_dedup, shingles
from entity360.llm.graph import components
from entity360.llm.near_dedup import drop_near_copies, joining_links, most_differing, near_groups
from entity360.llm.queries import QUERIES
from entity360.llm.shingles import shingle_sets
from tests.llm.cases import FOLDER, documents, empty, messy, messy_rows, table_of


def _set(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3)))


def _expected(rows):
    """Component per row by all pairs."""
    sets = [_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    return sets, [find(x) for x in range(len(rows))]


def _check(rows, got):
    sets, roots = _expected(rows)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    expected = sorted(
        (i if i is not None else -1, len(s), least.get(r, -1))
        for (i, _), s, r in zip(rows, sets, roots, strict=True)
    )
    found = sorted(
        (r[0] if r[0] is not None else -1, r[1], r[2] if r[2] is not None else -1) for r in got
    )
    assert found == expected


def test_query_agrees_with_all_pairs(spark):
    got = QUERIES["op5_minhash_near_dedup"](spark, FOLDER)
    rows = got.collect()
    _check(documents(spark), [(r.doc_id, r.n_shingles, r.component_id) for r in rows])
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_chains_of_copies_hold_together(spark):
    random.seed(5)
    words = [f"w{i}" for i in range(100)]
    rows, text = [], list(words)
    for i in range(60):  # each is a copy of the one before, the first and the last are far apart
        text = list(text)
        text[random.randrange(100)] = f"new{i}"
        rows.append((1_000 - i, " ".join(text)))
    rows += [(i, " ".join(random.choices(words, k=90))) for i in range(60)]
    got = near_groups(table_of(spark, rows)).collect()
    _check(rows, [(r.id, r.n_shingles, r.component_id) for r in got])


def test_odd_rows(spark):
    got = near_groups(messy(spark)).collect()
    _check(messy_rows(), [(r.id, r.n_shingles, r.component_id) for r in got])
    assert near_groups(empty(spark)).count() == 0


def test_dropping_keeps_one_document_a_component(spark):
    docs = messy(spark)
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    texts = sorted((r.text is not None, r.text or "") for r in left.collect())
    # Null, empty and blank texts link with nothing; rows that repeat id and text stay together.
    assert [t for _, t in texts].count("a text without an id") == 2
    assert [t for _, t in texts].count("the same row twice") == 2
    assert "The  Same\trow twice" not in [t for _, t in texts]
    assert len([t for _, t in texts if t.startswith("word number")]) == 1
    assert drop_near_copies(empty(spark)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a int, b int")).collect()}
    assert got == {i: 0 for i in range(21)} | {100 + i: 100 for i in range(30)}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_sets_of_texts_split_into_pieces():
    texts = ["A b c d E", "", "x y", "x\ty", "b c d e", "é é é é é"]
    sets = list(shingle_sets(texts, 4))
    assert [len(s) for s in sets] == [2, 0, 1, 1, 1, 1]
    assert np.array_equal(sets[2], sets[3]) and np.isin(sets[4], sets[0]).all()


def test_the_sieve_lies_above_what_similar_sets_give():
    random.seed(1)
    for n in (10, 200, 3_000):
        differ = n * 20 // 100
        bound = most_differing(1_024, np.array([differ]))[0]
        worst = max(
            sum(c % 2 for c in np.bincount([random.randrange(1_024) for _ in range(differ)])) for _ in range(200)
        )
        assert worst <= bound


def test_texts_hashed_in_steps_give_the_same_words(monkeypatch):
    random.seed(3)
    texts = ["".join(random.choices("ab \n", weights=[9, 9, 2, 1], k=k)) for k in (0, 1, 7, 8, 9, 40, 200)]
    texts += ["x" * 50, " " * 20 + "y" * 33 + " z", "Ä" * 30]
    whole = [s.tolist() for s in shingle_sets(texts, 2)]
    for size in (1, 2, 7, 8, 64):
        monkeypatch.setattr(shingles, "PIECE_BYTES", size)
        assert [s.tolist() for s in shingle_sets(texts, 2)] == whole


def _family(rng, members):
    """Texts around one, some of which are linked with few of the others."""
    base = [f"w{i}" for i in range(120)]
    out = []
    for i in range(members):
        words = list(base)
        for at in rng.sample(range(120), rng.randint(0, 6)):
            words[at] = f"new{i}-{at}"
        out.append((i, " ".join(words)))
    return out


def test_groups_of_many_parts_lose_no_connection_in_small_pieces(spark, monkeypatch):
    rng = random.Random(8)
    rows = _family(rng, 120)
    for name, size in (("BLOCK", 9), ("BLOCK_SHINGLES", 900)):
        monkeypatch.setattr(near_dedup, name, size)
    got = near_groups(table_of(spark, rows)).collect()
    _check(rows, [(r.id, r.n_shingles, r.component_id) for r in got])


def test_a_piece_puts_out_fewer_links_than_it_has_nodes():
    rng = random.Random(8)
    rows = _family(rng, 60)
    minhash, made = near_dedup.MinHash(near_dedup.SAMPLES), []
    for i, hashes in enumerate(shingle_sets([t for _, t in rows], near_dedup.WIDTH)):
        samples = minhash.samples(hashes)
        sketch = near_dedup.odd_sketch(samples, near_dedup.SKETCH_WORDS).tobytes()
        parity = near_dedup.parity_of(hashes, near_dedup.PARITY_WORDS).tobytes()
        made.append((1, 0, 0, 0, bytes([i]), bytes([i]), len(hashes), sketch, parity, hashes.tobytes()))
    names = [field.split()[0] for field in near_dedup._WORK.split(", ")]
    links = joining_links(pd.DataFrame(made, columns=[*names, "hashes"]))
    _, roots = _expected(rows)
    assert len(links) == 60 - len(set(roots))
    assert all(roots[a[0]] == roots[b[0]] for a, b in links)
