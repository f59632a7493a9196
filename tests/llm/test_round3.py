"""MinHash near-duplicates, token alignment and spelling variants."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from functools import partial

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketbars.llm import minhash_dedup, spelling, token_alignment
from marketbars.llm.queries import QUERIES

LONG = " ".join(f"word{k % 977}" for k in range(60_000))


@pytest.fixture(scope="module")
def load():
    paths = (token_alignment.A_FILE, token_alignment.B_FILE)
    return partial(token_alignment.sides, *map(token_alignment.tokenizer_path, paths))


# Near-duplicates


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return set()
    size = min(5, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def near_groups(docs):
    """By comparing all pairs: (n_shingles, component) of each id."""
    sets = {i: shingles(t) for i, t in docs.items()}
    low = {i: i for i in docs}
    links = [
        (a, b)
        for a in docs
        for b in docs
        if a < b
        and sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    for _ in docs:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return {i: (len(sets[i]), low[i]) for i in docs}


def edited(base, *places):
    words = base.split()
    for k in places:
        words[k] = f"other{k}"
    return " ".join(words)


BASE = " ".join(f"w{k}" for k in range(204))  # 200 shingles


def test_minhash_groups_equal_all_pairs(make_docs):
    texts = {
        1: BASE, 2: BASE.upper(), 3: edited(BASE, 0), 4: edited(BASE, 50, 100),
        # 16 of 200 shingles differ from the base's, then 32 of the chain's start
        5: edited(BASE, 0, 20, 40, 60), 6: edited(BASE, 0, 20, 40, 60, 80, 100, 120),
        7: None, 8: "", 9: " \t\n", 10: "a b c", 11: "A  b\tc", 12: "a b c d", 13: LONG,
        14: edited(LONG, 7), 15: "a b c d e", 16: "É a b c d", 17: "é a b c d",
    }
    docs = make_docs(*texts.items())
    got = {
        r.doc_id: (r.n_shingles, r.component_id)
        for r in minhash_dedup.near_duplicates(docs).collect()
    }
    assert got == near_groups(texts)
    assert got[6][1] == 1 and got[17] == (1, 17) and got[11][1] == 10


def test_minhash_rows_without_id_and_repeated_rows(make_docs):
    docs = make_docs((None, BASE), (4, BASE), (4, edited(BASE, 3)), (4, "x"), (None, "y"), (9, "x"))
    got = sorted(
        (r.n_shingles, str(r.doc_id), str(r.component_id), r.kept)
        for r in minhash_dedup.near_duplicates(docs).collect()
    )
    assert got == [
        (1, "4", "4", True), (1, "9", "4", False), (1, "None", "None", False),
        (200, "4", "4", True), (200, "4", "4", True), (200, "None", "4", False),
    ]
    assert minhash_dedup.near_duplicates(docs.limit(0)).collect() == []


def test_minhash_of_a_large_group_makes_no_pairs(spark, make_docs):
    """Copies that each differ in another word: pairs to confirm grow with the group."""
    docs = make_docs(*((k, edited(BASE, k % 200)) for k in range(400)))
    rows = docs.select("doc_id", "text")
    described = rows.select(
        "doc_id", *minhash_dedup._text_keys(rows.text), rows.text.cast("binary").alias("text")
    ).mapInArrow(minhash_dedup._described(5), minhash_dedup.SET_KIND)
    nodes = minhash_dedup.set_nodes(described)
    assert nodes.count() == 200
    roots = minhash_dedup.node_roots(nodes, rows)
    assert roots.select("root").distinct().count() == 1 and roots.count() == 200


def test_minhash_estimates_similarity():
    one = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    other = one.copy()
    other[:150] += np.uint64(12345)  # 850 of 1150
    agree = (minhash_dedup.minima(one) == minhash_dedup.minima(other)).mean()
    assert abs(agree - 850 / 1150) < 0.12


# Spelling


def test_spelling_of_small_texts(spark, make_docs):
    h = lambda i, w: zlib.crc32(f"{i}:{w}".encode()) % 199
    plain = [k for k in range(300) if all(h(k, w) for w in ("letter", "lettre", "lette", "élève", "naïveté", "naivete", "lettér", "lexter", "lexxer"))]
    hit = next(k for k in range(10_000) if h(k, "letters") == 0)
    cut = zlib.crc32(f"{hit}:letters".encode()) % 7
    left = "letters"[:cut] + "letters"[cut + 1 :]
    docs = make_docs(
        *((k, "LETTER letter, lette élève") for k in plain[:100]),
        *((k, "lexter") for k in plain[100:120]),
        *((k, "lexxer") for k in plain[120:124]),
        *((k, "naïveté") for k in plain[130:155]),
        *((k, "naivete") for k in plain[155:160]),
        *((k, "naiveté") for k in plain[160:165]),
        *((hit, "letters") for _ in range(5)),
        (None, None), (1, ""), (2, "x" * 100_000),
    )
    got = {r.word: tuple(r)[1:] for r in spelling.spelling_forms(docs).collect()}
    near = 1 + one_edit("letter", left)
    assert got["letter"] == (None, "letter", 200 + 5 * (left == "letter"), near, None)
    assert got["lexter"][:3] == ("letter", "letter", 20)
    # 5 of it, 5 and 25 times as many near: two edits part the outer ones
    assert got["naivete"] == (None, "naivete", 5, 1, None)
    assert got["naiveté"] == ("naïveté", "naïveté", 5, 2, 25)
    assert "lexxer" not in got and "élève" not in got and left in got
    assert spelling.spelling_forms(docs.limit(0)).collect() == []


def test_spelling_follows_forms_to_the_last(spark):
    n = {"aaaaaa": 1000, "aaaaab": 200, "aaaabb": 40, "aaabbb": 8}
    forms = spark.createDataFrame(
        [("aaabbb", "aaaabb"), ("aaaabb", "aaaaab"), ("aaaaab", "aaaaaa")], "word string, form string"
    )
    got = {r.word: r.root for r in spelling._roots(forms).collect()}
    assert got == {w: "aaaaaa" for w in n if w != "aaaaaa"}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def test_near_pairs_equal_all_pairs(spark):
    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.choice(list("abcé"), rng.integers(6, 9))) for _ in range(700)})
    frame = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = {(r.a, r.b) for r in spelling.near_pairs(frame).collect()}
    expected = {(a, b) for k, a in enumerate(words) for b in words[k + 1 :] if one_edit(a, b)}
    assert expected and got == expected


# Token alignment


def aligned(both, text):
    """Ids and groups, walking the text offset by offset."""
    a = both.a.encode(" " + (text or ""), add_special_tokens=False).ids
    b = both.b.encode(text or "")
    one, two = b"".join(both.a_bytes[k] for k in a), b"".join(both.b_bytes[k] for k in b)
    if not text or not one == two == (" " + text).encode():
        return []
    groups, i, j, at_a, at_b = [([], [])], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            groups[-1][0].append(a[i])
            at_a += len(both.a_bytes[a[i]])
            i += 1
        else:
            groups[-1][1].append(b[j])
            at_b += len(both.b_bytes[b[j]])
            j += 1
        if at_a == at_b:
            groups.append(([], []))
    return groups[:-1]


def expected_rows(both, texts):
    groups = {i: aligned(both, t) for i, t in texts.items()}
    links = {i: [(p, q) for x, y in g for p in x for q in y] for i, g in groups.items()}
    held = Counter(pair for found in links.values() for pair in set(found))
    best = {}
    for (p, _), n in held.items():
        best[p] = max(best.get(p, 0), n)

    def written(g):
        return ";".join("|".join(",".join(map(str, side)) for side in pair) for pair in g)

    return {
        i: (
            sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links[i]),
            sum(held[x] == best[x[0]] for x in links[i]), sum(held[x] for x in links[i]),
            hashlib.sha256(written(g).encode()).hexdigest() if g else "",
        )
        for i, g in groups.items()
    }


ODD = {
    1: "Hello <|endoftext|> world <s> </s> <0x0A> ▁x", 2: None, 3: "", 4: " ", 5: "  two  spaces ",
    6: "tab\there\nand\r\n there   x", 7: "naïve Übung 日本語のテキスト 😀😀 ‍",
    8: "=" * 3000 + " " + "-" * 777, 9: "a" * 5000, 10: LONG, 11: "ﬁ ½ é \x00\x1c x \x85 y",
    12: "<|endoftext|>", 13: "x ", 14: " x", 15: "Hello world", 16: "Hello world",
}


@pytest.mark.parametrize("options", [{}, {"work": 50}, {"work": 300, "pairs_sent": 0}])
def test_alignment_equals_walking_the_text(make_docs, load, options):
    docs = make_docs(*ODD.items())
    got = {r.doc_id: tuple(r)[1:] for r in token_alignment.align(docs, **options).collect()}
    assert got == expected_rows(load(), ODD)
    assert got[1][0] == 0 and got[6][0] > 0


def test_alignment_over_the_whole_table(spark, sf_dir, tables, load):
    texts = dict(tables.execute("select doc_id, text from documents").fetchall())
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_token_alignment"](spark, sf_dir).collect()}
    assert got == expected_rows(load(), texts)


def test_alignment_of_repeated_rows_and_missing_ids(make_docs, load):
    docs = make_docs((3, "one two"), (3, "one two"), (None, "one two"), (None, None))
    rows = token_alignment.align(docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["3", "3", "None", "None"]
    full = [r for r in rows if r.n_a]
    assert all(r.count_sum == 3 * r.n_links and r.n_best == r.n_links for r in full)
    assert token_alignment.align(docs.limit(0)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_fast_ids_equal_those_of_the_tokenizer(load, text):
    both = load()
    assert both.fast_a is not None
    assert list(both.a_ids(text)) == both.a.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.integers(1, 4), min_size=1, max_size=60),
    st.lists(st.integers(1, 4), min_size=1, max_size=60),
    st.integers(1, 40),
)
def test_pieces_of_the_merge_path_hold_every_common_end_once(one, two, work):
    a_ends, b_ends = np.cumsum(one), np.cumsum(two)
    places = token_alignment.cut_path(a_ends, b_ends, work)
    assert places[0] == (0, 0) and places[-1] == (len(one), len(two))
    found = []
    for (i, j), (i_end, j_end) in zip(places, places[1:]):
        assert 0 < (i_end - i) + (j_end - j) <= work + 1
        cut, _ = token_alignment.overlaps(a_ends[i:i_end], b_ends[j:j_end])
        found += [a_ends[i + k - 1] for k in cut]
    assert found == sorted(set(a_ends) & set(b_ends))


def test_links_of_a_large_group(monkeypatch):
    a, b = np.array([1, 1, 2, 5], np.int32), np.array([7, 7, 8, 9], np.int32)
    cuts = np.array([3, 4]), np.array([3, 4])
    plain = token_alignment.links(a, b, *cuts)
    monkeypatch.setattr(token_alignment, "LARGE_GROUP", 2)
    large = token_alignment.links(a, b, *cuts)
    assert [x.tolist() for x in plain] == [x.tolist() for x in large]
    assert dict(zip(plain[0].tolist(), plain[1].tolist()))[1 << 32 | 7] == 4
