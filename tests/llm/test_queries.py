"""Each registered query over its whole table, against SQL or brute force."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from marketbars.llm.license_scan import NOTICES
from marketbars.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def result(spark, sf_dir):
    done = {}

    def of(name):
        if name not in done:
            frame = QUERIES[name](spark, sf_dir)
            done[name] = (frame.columns, frame.collect())
        return done[name][1]

    of.columns = lambda name: (of(name), done[name][0])[1]
    return of


@pytest.fixture(scope="module")
def texts(tables):
    return dict(tables.execute("select doc_id, coalesce(text, '') from documents").fetchall())


def by_name(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(row[i] for i in order) for row in rows]
    return sorted(rows, key=lambda row: [(v is not None, v) for v in row])  # nulls first


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, result, tables):
    cursor = tables.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    expected = by_name(cursor.fetchall(), names)
    assert expected and sorted(names) == sorted(result.columns(name))
    assert by_name(result(name), result.columns(name)) == expected


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))


def test_html_equals_the_article(result, tables):
    rows = {r.page_id: r for r in result("op1_html_extraction")}
    pages = tables.execute("select page_id, html from pages").fetchall()
    assert len(rows) == len(pages)
    for page_id, page in pages:
        article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        blocks = re.split(r"</?(?:p|h\d)>", article)
        plain = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks]
        expected = "\n\n".join(b for b in plain if b)
        assert rows[page_id].text == expected
        assert rows[page_id].n_chars == len(expected)


def test_quality_on_held_out_labels(result, tables):
    rows = {r.doc_id: r for r in result("op3_quality")}
    hits = [
        rows[i].kept == bool(q)
        for i, q in tables.execute("select doc_id, quality from labels").fetchall()
        if rows[i].held_out
    ]
    assert len(hits) > 10 and sum(hits) / len(hits) > 0.9


def simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    parts = [b" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts] if words else [0]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints, limit):
    """Smallest id reachable, by comparing all pairs."""
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= limit:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in prints}


def test_near_groups_equal_all_pairs(result, texts):
    prints = {i: simhash(t) for i, t in texts.items()}
    expected = roots(prints, 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in result("op4_simhash_near_dedup")}
    assert got == {i: (f"{p:016x}", expected[i]) for i, p in prints.items()}


def test_mix_meets_its_targets(result, texts, tables, spark, sf_dir):
    source = dict(tables.execute("select doc_id, source from documents").fetchall())
    size = {i: len(WORD.findall(t)) for i, t in texts.items()}
    total = Counter()
    for i, n in size.items():
        total[source[i]] += n
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(total))}
    goal, target, left = 1.5 * sum(size.values()), {}, set(total)
    while True:
        level = (goal - sum(target.values())) / sum(weight[s] for s in left)
        over = [s for s in left if level * weight[s] > 2 * total[s]]
        if not over:
            break
        target |= {s: 2.0 * total[s] for s in over}
        left -= set(over)
    target |= {s: level * weight[s] for s in left}
    rows = result("op6_mixing")
    taken, of = Counter(), {}
    for r in rows:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], total[s])
        assert r.target == pytest.approx(target[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
        of.setdefault(s, []).append(r)
    assert len(rows) == len(size)
    # Near the target, or no document is left whose turning would bring the source nearer.
    for s, part in of.items():
        miss, base = target[s] - taken[s], target[s] // total[s]
        side = [r.size for r in part if r.size and r.taken // r.size == base + (miss < 0)]
        assert abs(miss) <= max(0.02 * target[s], min(side, default=miss) / 2)
    assert sorted(QUERIES["op6_mixing"](spark, sf_dir).collect()) == sorted(rows)


def test_toxicity_on_labels(result, tables):
    rows = {r.doc_id: r for r in result("op7_toxicity")}
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    clean = [i for i, t in tables.execute("select doc_id, toxic from labels").fetchall() if not t]
    assert sum(rows[i].predicted for i in clean) / len(clean) < 0.05


def shingles(text):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return [tuple(words[k : k + 5]) for k in range(len(words) - 4)]


def test_license_scan_equals_comparing_every_window(result, texts):
    got = {(r.doc_id, r.license) for r in result("op8_license_scan")}
    expected = set()
    for name, notice in NOTICES.items():
        own = set(shingles(notice))
        reach = int(1.5 * len(own)) + 1
        for i, text in texts.items():
            there = shingles(text)
            if len(own & set(there)) >= 0.8 * len(own) and any(
                s in own and len(own & set(there[k : k + reach])) >= 0.8 * len(own)
                for k, s in enumerate(there)
            ):
                expected.add((i, name))
    assert got == expected


def test_packing_is_the_tokenizers_and_tight(result, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in result("op9_best_fit_packing"):
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, text in texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        cut = [ids[k : k + 2048] for k in range(0, len(ids), 2048)]
        assert sorted(pieces[i]) == [
            (k, 2048 * k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
            for k, part in enumerate(cut)
        ]
    total = 0
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 2048
        total += end
    assert len(sequences) <= -(-total // 2048) * 1.02 + 1


def test_shards_are_even(result, texts):
    rows = result("op10_sharding")
    loads, slots = Counter(), defaultdict(list)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert r.law == "bytes" and r.grown_shard is None
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(rows) == len(texts) and set(loads) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads.values()) - min(loads.values()) <= 0.02 * sum(loads.values()) / 16
