"""The operators against brute force, round trips and edge cases on small inputs."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from conftest import SF, as_rows

from tabulon.llm import attention, chat, gif, htmltext, linededup, lmscore, mixing, packing, queries, simhash, topk, toxicity

DOCS = "doc_id long, text string, source string, fingerprint int, size int, component_id int"


def docs_of(spark, rows):
    """Documents with extra columns whose names clash with results."""
    return spark.createDataFrame([(i, t, s, 1, 2, 3) for i, t, s in rows], DOCS)


EDGE = [(1, "one two three four", "a"), (2, None, "b"), (3, "", None), (4, "One TWO three four", "a"), (None, "one two three four", "a"),
        (1, "one two three four", "a"), (5, "w " * 5000 + "end", "a"), (6, "naïve ÄÖ x\ty", "b")]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    assert as_rows(queries.QUERIES[name](spark, SF).toPandas()) == as_rows(db.execute(queries.ORACLE_SQL[name]).df())


# --- chat ---------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, k int, n_copies int"


def test_chat_keeps_maximal_conversations(spark):
    logs = {1: "ab", 2: "abc", 3: "abc", 4: "ax", 5: "a", 6: "b", None: "z"}
    rows = [(c, k, "user", t, 0, 0) for c, ts in logs.items() for k, t in enumerate(ts)]
    rows += [(None, k, "user", x, 0, 0) for k, x in enumerate("zayy")] + [(7, 0, None, None, 0, 0), (8, 1, "user", "q", 0, 0), (8, 1, "user", "q", 0, 0)]
    out = chat.chat_format(spark.createDataFrame(rows, TURNS)).collect()
    got = {r.conv_id: (r.n_turns, r.n_copies) for r in out if r.conv_id is not None}
    assert got == {2: (3, 2), 4: (2, 1), 6: (1, 1), 7: (1, 1), 8: (2, 1)}
    # turns without a conversation id are conversations by themselves; one of them begins another conversation
    assert sorted((r.text, r.n_copies) for r in out if r.conv_id is None) == [(f"<|im_start|>user\n{x}<|im_end|>\n", n) for x, n in (("y", 2), ("z", 2))]


def test_chat_empty(spark):
    assert chat.chat_format(spark.createDataFrame([], TURNS)).count() == 0


# --- simhash -----------------------------------------------------------------------------

def brute_components(fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def plain_fingerprint(text):
    import xxhash

    w = text.encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint_is_the_plain_one():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 300, 900):
        text = " ".join(rng.choice(["the", "Ab", "é", "x1"]) for _ in range(n))
        assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("pairwise", [0, 1000])
def test_links_reach_what_all_pairs_reach(pairwise):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(4)]
    fps = list({b ^ sum(1 << p for p in rng.sample(range(16), rng.randint(0, 3))) for b in base for _ in range(60)})
    a, b = simhash.link_posting(np.array(fps, dtype=np.uint64).view(np.int64), 2, pairwise)
    pairs = list(zip(a.view(np.uint64).tolist(), b.view(np.uint64).tolist()))
    assert all(bin(x ^ y).count("1") <= 2 for x, y in pairs)
    want = brute_components(fps)
    index = {f: i for i, f in enumerate(fps)}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in pairs:
        root[find(index[x])] = find(index[y])
    got = [find(i) for i in range(len(fps))]
    assert {frozenset(np.flatnonzero(np.array(got) == g)) for g in set(got)} == {frozenset(np.flatnonzero(np.array(want) == g)) for g in set(want)}


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    words = ["w%d" % i for i in range(50)]
    rows = list(EDGE)
    for i in range(10, 60):
        t = [rng.choice(words) for _ in range(400)]
        rows.append((i, " ".join(t), "a"))
        t[0] = "changed"
        rows.append((i + 100, " ".join(t), "a"))
    got = simhash.near_duplicates(docs_of(spark, rows)).collect()
    texts = {t or "" for _, t, _ in rows}
    fp = {t: plain_fingerprint(t) for t in texts}
    comp = brute_components([fp[t or ""] for _, t, _ in rows])
    low = {}
    for (i, _, _), c in zip(rows, comp):
        low[c] = i if low.get(c) is None else low[c] if i is None else min(low[c], i)
    want = sorted((str(i), fp[t or ""], str(low[c])) for (i, t, _), c in zip(rows, comp))
    assert sorted((str(r.id), r.fp % 2**64, str(r.component_id)) for r in got) == want
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


# --- line dedup -----------------------------------------------------------------------------

def test_line_dedup_removes_later_copies_only(spark):
    passage = "\n".join(f"passage line {i} with several words in it" for i in range(4))
    long_line = "w " * 60
    rows = [(1, "x one\n" + passage + "\ny one", "a"), (2, "a two\nb two\n" + passage, "a"), (3, passage + "\nzzz", "a"), (4, "unique line\nother", "a"),
            (5, None, "a"), (6, "", "a"), (7, long_line + "\nq", "a"), (8, "p\n" + long_line, "a"), (1, "x one\n" + passage + "\ny one", "a"), (9, "q", "a")]
    out = linededup.dedup_lines(docs_of(spark, rows)).collect()
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out if r.doc_id != 5)
    kept = "x one\n" + passage + "\ny one"
    assert got == [(1, kept, 6, 0), (1, kept, 6, 0), (2, "a two\nb two", 6, 4), (3, "zzz", 5, 4), (4, "unique line\nother", 2, 0), (6, "", 1, 0),
                   (7, long_line + "\nq", 2, 0), (8, "p", 2, 1), (9, "q", 1, 0)]
    assert [r.text for r in out if r.doc_id == 5] == [None]
    assert linededup.dedup_lines(docs_of(spark, [])).count() == 0


def test_chunk_cuts_resist_shifts():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 400).astype(np.uint64)

    def chunks(pairs):
        same = np.arange(len(pairs)) > 0
        first, last, value = linededup.chunks_of(pairs, same)
        assert len(set(value.tolist())) == len(value) and (last >= first).all()
        return {tuple(pairs[a : b + 1]) for a, b in zip(first, last)}

    whole, moved = chunks(h), chunks(h[3:])
    edited = chunks(np.concatenate([h[:200], rng.integers(0, 2**63, 2).astype(np.uint64), h[201:]]))
    assert len(whole) > 60 and len(whole & moved) >= len(whole) - 3 and len(whole & edited) >= len(whole) - 3
    assert [len(x) for x in linededup.chunks_of(h[:0], np.zeros(0, bool))] == [0, 0, 0]


def plain_runs(docs):
    """Lines that go: maximal runs of adjacent lines that follow the first occurrences of their pairs."""
    placed = {i: [(k, x) for k, x in enumerate(t.split("\n")) if x.strip()] for i, t in docs.items()}
    pairs = {(i, o): (x, y, q - p) for i, ls in placed.items() for o, ((p, x), (q, y)) in enumerate(zip(ls, ls[1:]))}
    count, first = Counter(pairs.values()), {}
    for at in sorted(pairs):
        first.setdefault(pairs[at], at)
    gone = {i: set() for i in docs}
    for i, ls in placed.items():
        o = 0
        while o < len(ls) - 1:
            kept = first[pairs[i, o]]
            if count[pairs[i, o]] < 2 or kept == (i, o):
                o += 1
                continue
            n = 1
            while (i, o + n) in pairs and first[pairs[i, o + n]] == (kept[0], kept[1] + n) and count[pairs[i, o + n]] > 1:
                n += 1
            shared = placed[i][kept[1] + n][0] if kept[0] == i else -1
            gone[i] |= {k for k in range(ls[o][0], ls[o + n][0] + 1) if k > shared}
            o += n
    return gone


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(17)
    lines = [f"line {k} x" for k in range(60)]
    docs = {}
    for i in range(200):
        t = []
        while len(t) < rng.randint(1, 25):
            at = rng.randrange(len(lines))
            t += lines[at : at + rng.choice([1, 1, 2, 2, 3, 6])] + [rng.choice(["", f"own {i} {len(t)}", " "])] * rng.randint(0, 1)
        docs[i] = "\n".join(t)
    gone = plain_runs(docs)
    got = {r.doc_id: (r.text, r.n_removed) for r in linededup.dedup_lines(docs_of(spark, [(i, t, "a") for i, t in docs.items()])).collect()}
    assert sum(map(len, gone.values())) > 500
    for i, t in docs.items():
        left = [x for k, x in enumerate(t.split("\n")) if k not in gone[i]]
        assert got[i] == ("\n".join(left), len(gone[i])), i


def test_two_line_runs_all_go_and_no_line_vanishes(spark):
    """What later copies of repeated two-line runs keep: nothing; and every line stays somewhere."""
    docs = {1: "u1\nA a\nB b\nC c\nu2", 2: "v1\nA a\nB b\nv2", 3: "w1\nC c\nw2", 4: "B b\nC c", 5: "x1\n\nA a\n\nB b", 6: "y\n\nA a\n\nB b\nz"}
    got = {r.doc_id: r.text for r in linededup.dedup_lines(docs_of(spark, [(i, t, "a") for i, t in docs.items()])).collect()}
    assert got == {1: docs[1], 2: "v1\nv2", 3: docs[3], 4: "", 5: docs[5], 6: "y\n\nz"}
    table = spark.read.parquet(f"{SF}/documents.parquet")
    before = {(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()}
    after = linededup.dedup_lines(table, long_lines=False).select("doc_id", "text").collect()
    lines_of = lambda texts: {x for t in texts for x in (t or "").split("\n") if x}
    assert lines_of(t for _, t in before) == lines_of(r.text for r in after)


def test_line_dedup_of_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b\nc d", 7, "x", True, 5), (2, "a b\nc d", 8, "y", None, 6)], "doc_id long, text string, n_lines int, `row` string, drop boolean, own_th int")
    out = linededup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "row", "drop", "own_th", "n_lines", "n_removed"]
    assert sorted(out.collect()) == [(1, "a b\nc d", "x", True, 5, 2, 0), (2, "", "y", None, 6, 2, 2)]


def test_line_dedup_finds_cropped_and_adjoining_passages(spark):
    rng = random.Random(13)
    lines = lambda n, k=12: [" ".join(rng.choice(["ab", "cd", "ef", "gh", "ij"]) + str(rng.randrange(999)) for _ in range(k)) for _ in range(n)]
    p, q, whole, m = lines(3, 20), lines(3, 20), lines(8), lines(6, 20)
    a = ["same same " * 8] * 6  # a line that repeats within its document: the first fifty words stay
    texts = {1: p + q, 2: lines(1) + p + lines(1), 3: q, 10: whole, 11: lines(1) + whole[2:7] + lines(2), 12: whole[:3] + lines(1) + whole[3:], 20: a,
             30: m, 31: m, 32: m[:3], 33: m[3:]}
    got = {r.doc_id: (r.n_removed, r.text) for r in linededup.dedup_lines(docs_of(spark, [(i, "\n".join(t), "a") for i, t in texts.items()])).collect()}
    assert {i: n for i, (n, _) in got.items()} == {1: 0, 2: 3, 3: 3, 10: 0, 11: 5, 12: 8, 20: 4, 30: 0, 31: 6, 32: 3, 33: 3}
    assert got[2][1].split("\n") == [texts[2][0], texts[2][4]]


# --- top-k ------------------------------------------------------------------------------

def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in rng.normal(0, 1 + i % 5, 6)]) for i in range(0, 260)]
    vectors += [(400, None), (500, [1.0, None]), (600, [float("nan")]), (700, [float("inf")]), (800, []), (901, vectors[0][1]), (902, vectors[0][1])]
    vectors += [(i, vectors[5][1]) for i in range(1001, 1040)] + [(1002, vectors[5][1])] * 3 + [(1100, [0.0] * 6)]
    got = topk.top_k(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect()
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, u in sorted(x for x in good if x[0] % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(u, v)), i) for i, v in good if i != q)[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(want)


def test_pruned_blocks_keep_all_winners():
    rng = np.random.default_rng(5)
    p = rng.integers(-1000, 1000, (500, 8))
    q = p[:20] + rng.integers(-20, 20, (20, 8))
    norm = lambda m: np.sqrt((m.astype(float) ** 2).sum(axis=1))
    scores = q @ p.T
    bound = np.sort(scores, axis=1)[:, -10].astype(float)
    at, to, found = topk.best_of_block(np.full(20, -1), q, norm(q), bound, np.arange(500), p, norm(p), 10)
    for i in range(20):
        assert sorted(np.array(found)[at == i].tolist())[::-1] == sorted(scores[i].tolist())[::-1][:10]


@pytest.mark.parametrize("sign", [-1, 1])
def test_pruning_keeps_winners_along_one_coordinate(sign):
    rng = np.random.default_rng(14)
    p = rng.integers(-250, 250, (600, 8))
    p[:, 3] = sign * rng.integers(500, 1000, 600)
    q, norm = p[:30], lambda m: np.sqrt((m.astype(float) ** 2).sum(axis=1))
    scores = q @ p.T
    for share in (0.72, 0.8, 0.9):  # bounds that prune by coordinates
        bound = share * norm(q) * norm(p).max()
        at, to, _ = topk.best_of_block(np.full(30, -1), q, norm(q), bound, np.arange(600), p, norm(p), 10)
        for i in range(30):
            want = sorted((x for x in scores[i] if x >= bound[i]), reverse=True)[:10]
            assert sorted(scores[i][to[at == i]], reverse=True) == want


def test_top_k_of_huge_components_clashing_names_and_an_empty_table(spark):
    kind = "vec_id long, embedding array<double>, norm string, block int, bounds string"
    rows = [(0, [1.0, 2.0]), (1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [3.0, 1.0]), (100, [1e300, 1e300])]
    df = spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], kind)
    top = 2**63 - 1
    cut = lambda x: max(-top - 1, min(top, math.floor(1024 * x) if abs(x) < 1e15 else (top if x > 0 else -top - 1)))
    want = []
    for q, u in rows:
        if q % 100 == 0:
            scores = sorted((-sum(cut(a) * cut(b) for a, b in zip(u, v)), i) for i, v in rows if i != q)
            want += [(q, k + 1, i, max(-top - 1, min(top, -s))) for k, (s, i) in enumerate(scores)]
    got = topk.top_k(df).collect()
    assert sorted((r.query_id, r.vec_id, r.score) for r in got) == sorted((q, i, s) for q, _, i, s in want)
    assert topk.top_k(df.limit(0)).count() == 0 and topk.top_k(df.where("vec_id = 3")).count() == 0


def test_coordinates_prune_where_few_of_them_hold_the_energy(spark):
    rng = np.random.default_rng(18)
    scale = 2.0 ** -np.arange(32)
    vectors = [(i, (rng.normal(0, 1, 32) * scale).tolist()) for i in range(3000)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    share = topk.pruning(df).collect()
    assert any(r.way == "coordinates" for r in share) and sum(r.products for r in share) < 0.3 * sum(r.pairs for r in share)
    good = np.array([np.floor(1024 * np.array(v)) for _, v in vectors])
    scores = good[::100] @ good.T
    got = {(r.query_id, r["rank"]): r.score for r in topk.top_k(df).collect()}
    for n, q in enumerate(range(0, 3000, 100)):
        assert [got[q, k + 1] for k in range(10)] == sorted(np.delete(scores[n], q).tolist(), reverse=True)[:10]


# --- gif ---------------------------------------------------------------------------------

def test_gif_round_trip():
    rng = random.Random(6)
    for n in (0, 1, 63, 64, 65, 5000, 70_000, 140_000):
        for raw in (bytes(rng.choices(range(256), k=n)), b"a" * n, (b"the quick brown " * (n // 16 + 1))[:n]):
            payload = raw + b"\0" * (-n % 64 if n else 64)
            assert gif.read_payload(gif.decode(gif.encode(payload))) == payload


def test_gif_disposal_transparency_and_interlace():
    import struct

    def frame(rect, index, disposal, clear=None, interlaced=False):
        stream = gif.lzw_encode(bytes(index))
        return (b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (clear is not None), 7, clear or 0) + b"\0\x2c" + struct.pack("<HHHHB", *rect, 0x40 if interlaced else 0)
                + b"\x08" + bytes([len(stream)]) + stream + b"\0")

    head = b"GIF89a" + struct.pack("<HHBBB", 2, 2, 0xF7, 0, 0) + gif._GREY
    data = head + frame((0, 0, 2, 2), [1, 2, 3, 4], 1) + frame((0, 0, 2, 1), [9, 5], 2, clear=9) + frame((1, 1, 1, 1), [8], 3) + frame((0, 0, 1, 1), [6], 0) + b"\x3b"
    shown = [(f.canvas & 255).tolist() for f in gif.decode(data)]
    assert shown == [[[1, 2], [3, 4]], [[1, 5], [3, 4]], [[0, 0], [3, 8]], [[6, 0], [3, 4]]]
    rows = head[:6] + struct.pack("<HHBBB", 1, 4, 0xF7, 0, 0) + gif._GREY + frame((0, 0, 1, 4), [0, 2, 1, 3], 0, interlaced=True) + b"\x3b"
    assert [f.canvas.ravel().tolist() for f in gif.decode(rows)][0] == [v | v << 8 | v << 16 | 255 << 24 for v in (0, 1, 2, 3)]
    with pytest.raises(ValueError):
        list(gif.decode(b"nonsense"))
    with pytest.raises(ValueError):
        list(gif.decode(data[:-20]))


def test_gif_columns(spark):
    df = docs_of(spark, EDGE)
    got = gif.digests(df).collect()
    assert len(got) == len(EDGE) and len({(r.n_bytes, r.media_sha256) for r in got}) == len({t or "" for _, t, _ in EDGE})
    frames = gif.frames(gif.to_media(df)).collect()
    assert all(f.error is None and f.delay_cs == gif.DELAY_CS and sum(f.histogram) == 3 * f.width * f.height for f in frames)


def test_gif_digests_by_hashlib(spark):
    import hashlib
    import zlib

    rows = EDGE + [(70, "very long text " * 20_000, "a"), (70, "very long text " * 20_000, "a"), (71, "x" * 64, "a"), (72, "é" * 33, "a")]
    got = gif.digests(docs_of(spark, rows)).collect()
    want = []
    for i, t, _ in rows:
        raw = (t or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 if raw else 64)
        media = gif.encode(payload)
        want.append((str(i), len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest()))
    assert sorted((str(r.id), *r[1:7]) for r in got) == sorted(want)
    levels = np.bincount(np.frombuffer(b"x" * 64, np.uint8) >> 4, minlength=16)
    assert {r.feature for r in got if r.id == 71} == {f"1x{gif.DELAY_CS}cs:" + ",".join(map(str, levels.tolist()))}
    assert gif.digests(docs_of(spark, [])).count() == 0


# --- toxicity ------------------------------------------------------------------------------

def test_toxicity_learns_words_and_their_misspellings(spark):
    rng = random.Random(7)
    clean = ["the", "house", "garden", "river", "stone", "walk", "green", "cloud", "paper", "music"]
    data = []
    for i in range(400):
        t = [rng.choice(clean) for _ in range(rng.randint(5, 80))]
        if i % 4 == 0:
            t[rng.randrange(len(t))] = rng.choice(["grubnak", "grubnaks", "Grubnakki"])
        data.append((i, " ".join(t), int(i % 4 == 0)))
    df = docs_of(spark, [(i, t, "a") for i, t, _ in data] + [(1000, "a grubnakish walk", "a"), (1001, "a green walk", "a"), (1002, None, "a"), (1003, "", "a")])
    labels = spark.createDataFrame([(i, y) for i, _, y in data] + [(None, 1), (5000, None)], "doc_id long, toxic int")
    got = {r.id: r for r in toxicity.toxicity(df, labels).collect()}
    assert np.mean([got[i].predicted == y for i, _, y in data if got[i].held_out]) > 0.95
    assert got[1000].score > 0.5 > got[1001].score and got[1002].score == got[1003].score
    none = toxicity.toxicity(df, labels.where("toxic = 0")).select("score").distinct().count()
    assert none == 1


# --- language model ------------------------------------------------------------------------

def test_lm_base_score_against_brute_force(spark):
    import zlib

    rows = EDGE + [(i, f"word{i % 7} the thing {i}", "a") for i in range(20, 60)]
    got = lmscore.score(docs_of(spark, rows)).collect()
    count = Counter()
    for i, t, _ in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            count.update([*lmscore.words_of(t or ""), b"\n"])
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), len(w) + 1, sum(count[x] > 0 for x in [*w, b"\n"]), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in [*w, b"\n"]), 6))
                  for i, t, _ in rows for w in [lmscore.words_of(t or "")])
    assert sorted((str(r.id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_windows_score_every_token_once_from_what_stands_before():
    tokens, ends = np.arange(100, 200), np.array([1, 40, 56, 57, 100])
    w = attention.windows(tokens, ends)
    at = w.at[w.scored]
    assert sorted(at.tolist()) == list(range(100))
    begins = {0, *ends.tolist()}
    for place, before in zip(at.tolist(), w.ids[w.scored].tolist()):
        assert before == (attention.END if place in begins else tokens[place - 1])


def test_attention_is_causal_and_normalised():
    w = attention.fresh()
    ids = np.random.default_rng(8).integers(0, 5000, (3, attention.WINDOW))
    states = lambda x: attention._forward(w, x)[-1].reshape(3, attention.WINDOW, -1)
    other = ids.copy()
    other[:, 9:] = 7
    assert np.allclose(states(ids)[:, :9], states(other)[:, :9], atol=1e-5)
    scored = np.ones(ids.shape, bool)
    total = sum(np.exp(attention.class_log_probs(w, ids, scored, np.full(ids.size, c))) for c in range(attention.CLASSES))
    assert np.allclose(total, 1, atol=1e-4)
    huge = {n: x * 400 for n, x in w.items()}
    assert np.isfinite(attention.class_log_probs(huge, ids, scored, np.zeros(ids.size, int))).all()


def test_gradient_steps_lower_the_loss():
    rng = np.random.default_rng(9)
    ids = np.tile(rng.integers(0, 50, attention.WINDOW), (16, 1))
    t, every = attention.Trainer(attention.fresh()), np.ones(ids.shape, bool)
    loss = lambda: -attention.class_log_probs(t.w, ids, every, ids.ravel() % attention.CLASSES).mean()
    before = loss()
    for _ in range(60):
        t.step(ids, ids % attention.CLASSES, every)
    assert loss() < 0.3 * before and t.seen == 60 * 16


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(21)
    ids = rng.integers(0, 4000, (2, attention.WINDOW))
    wanted, valid = rng.integers(0, attention.CLASSES, ids.shape), rng.random(ids.shape) < 0.8
    w = attention.fresh()
    t = attention.Trainer(w, rate=1e-3)
    t.step(ids, wanted, valid)
    loss = lambda x: -attention.class_log_probs({n: a.astype(np.float64) for n, a in x.items()}, ids, valid, wanted[valid]).mean()
    for name, at in (("out", (3, 5)), ("bias", (7,)), ("o", (2, 9)), ("qkv", (4, 1)), ("qkv", (4, 20)), ("qkv", (4, 40)), ("pos", (6, 3)), ("emb", (int(attention.ROW[ids[0, 4]]), 2))):
        up, down = ({n: a.copy() for n, a in w.items()} for _ in range(2))
        up[name][at] += 1e-2
        down[name][at] -= 1e-2
        slope = (loss(up) - loss(down)) / 2e-2
        step = w[name][at] - t.w[name][at]  # Adagrad's first step: rate * g / sqrt(g * g + 1e-6)
        assert abs(step - 1e-3 * slope / math.sqrt(slope * slope + 1e-6)) < 1e-4, name


def plain_log10(model, ids):
    """log10 probability of each id of one text, place by place."""
    w, out = model.weights, []
    for p, wanted in enumerate(ids):
        nth = 0 if p < attention.WINDOW else (p - attention.WINDOW) // attention.STEP + 1
        start = nth * attention.STEP
        before = [attention.END if i == 0 else ids[i - 1] for i in range(start, p + 1)]
        x = np.array([w["emb"][attention.ROW[b]] + w["pos"][i] for i, b in enumerate(before)], np.float64)
        q, k, v = np.split(x @ w["qkv"], 3, axis=1)
        e = np.exp(q[-1] @ k.T)
        z = (x[-1] + (e / e.sum()) @ v @ w["o"]) @ w["out"] + w["bias"]
        c = model.classes_of[wanted]
        out.append((z[c] - np.log(np.exp(z).sum())) / math.log(10) + model.in_class[model.classes_of[before[-1]], wanted])
    return out


def test_lm_score_against_brute_force(spark):
    from tabulon.llm.common import stored

    rows = EDGE[:6] + [(i, " ".join(f"word{(i * k) % 9} the thing {i}" for k in range(1 + i % 13)), "a") for i in range(20, 90)]
    source = docs_of(spark, rows).selectExpr("doc_id AS id", "crc32(cast(coalesce(cast(doc_id AS string), '') AS binary)) % 7 = 2 AS held", "coalesce(text, '') AS text")
    tokens = stored(lmscore.tokenized(source), "t")
    counts = stored(tokens.where("word IS NOT NULL").groupBy("word").agg({"n": "sum"}).toDF("word", "c"), "t")
    fitted = lmscore.fit(tokens, counts)
    assert np.allclose(np.exp(math.log(10) * fitted.model.in_class.astype(float)).sum(axis=1), len(set(fitted.model.classes_of)), atol=1e-3)
    got = lmscore.scored(tokens.where("ids IS NOT NULL").select("id", "th", "ids"), counts, fitted).collect()
    sub, want = lmscore.subwords(), []
    for i, t, _ in rows:
        words = [np.frombuffer(sub[x], np.uint16).tolist() for x in lmscore.words_of(t or "")] + [[attention.END]]
        each = plain_log10(fitted.model, [x for word in words for x in word])
        total, at = 0.0, 0
        for word in words:
            share = fitted.common.get(np.array(word, np.uint16).tobytes(), 0) / fitted.cached
            total += math.log10(lmscore.CACHE_SHARE * share + (1 - lmscore.CACHE_SHARE) * 10 ** sum(each[at : at + len(word)]))
            at += len(word)
        want.append((str(i), len(words), round(total, 2)))
    assert [x[:2] for x in sorted((str(r.id), r.n_tokens, r.score) for r in got)] == [x[:2] for x in sorted(want)]
    assert np.allclose([x[2] for x in sorted((str(r.id), r.n_tokens, r.score) for r in got)], [x[2] for x in sorted(want)], rtol=1e-3, atol=0.05)


def test_lm_of_an_empty_table_and_of_held_out_rows_only(spark):
    assert lmscore.score(docs_of(spark, [])).count() == 0
    got = lmscore.score(docs_of(spark, [(6, "a b", "x"), (6, "a b", "x")])).collect()  # crc32('6') % 7 == 2
    assert [(r.held_out, r.n_known, r.train_tokens) for r in got] == [(True, 0, 0)] * 2 and all(math.isfinite(r.score) for r in got)


# --- mixing ---------------------------------------------------------------------------------

def test_mix_targets_and_bounds(spark):
    rng = random.Random(10)
    rows = EDGE + [(i, "w " * rng.randint(0, 60), rng.choice(["a", "b", "c", None])) for i in range(100, 900)]
    got = mixing.mix(docs_of(spark, rows)).collect()
    again = mixing.mix(docs_of(spark, rows)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == len(rows)
    assert all(0 <= r.copies <= 2 for r in got)
    total = sum(r.size for r in got)
    by = {r.source: (r.source_size, r.target) for r in got}
    assert abs(sum(t for _, t in by.values()) - 1.5 * total) < 1e-6 * total and all(t <= 2 * s + 1e-9 for s, t in by.values())
    for s, (_, target) in by.items():
        if s != "a":  # a holds one document of most of its words
            assert abs(sum(r.size * r.copies for r in got if r.source == s) - target) < 0.1 * target
    assert mixing.mix(docs_of(spark, [])).count() == 0


def test_mixed_takes_each_row_by_its_own_copies(spark):
    rng = random.Random(15)
    rows = EDGE + [(None if i % 3 == 0 else i // 2, f"t{i} " + "w " * rng.randint(0, 60), rng.choice(["a", "b", "c", None])) for i in range(100, 700)]
    rows += [(5000, "the same row " * 5, "b")] * 30
    want = Counter()
    for r in mixing.mix(docs_of(spark, rows)).collect():
        want[r.id, r.source, r.size] += r.copies
    out = mixing.mixed(docs_of(spark, rows))
    assert out.columns == docs_of(spark, []).columns
    got = Counter((r.doc_id, r.source, len((r.text or "").encode().split())) for r in out.collect())
    assert got == +want
    assert {(r.doc_id, r.text, r.source) for r in out.collect()} <= set(rows)


# --- html ----------------------------------------------------------------------------------

@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain text only", "plain text only"),
    ("<nav>m</nav><article><h1>T&amp;t</h1><p>a<b>b</b> c<br>d<p>e</article><footer>f</footer>", "T&t ab c d e"),
    ("<article><p>x<script>var t='</p>';</script>y<!-- n --><style>p{}</style></p></article>", "xy"),
    ("<div class=ad>buy<article><p>kept</p></article>", "kept"),
    ("<article><p>a</p><div class='comments'><p>no</p></div><aside>no</aside><p>b</p><form>no</form></article>", "a b"),
    ("<main><p>&nbsp;a\n\n b&#233;</p></main><section id=comments><article>no</article></section>", "a bé"),
    ("<div id='content'><p>" + "aa bb " * 30 + "</p><div class=sidebar>s</div><p>b</p></div><p>tail</p>", ("aa bb " * 30) + "b"),
    ("<p>intro</p><a href=x>" + "link text " * 40 + "</a><h2>Head</h2><p>" + "body text " * 30 + "</p><hr><p>x</p><p>y</p><p>z</p>", "Head " + ("body text " * 30).strip()),
    ("<article><p>one</p></article><p>x</p><article><p>" + "long words " * 30 + "</p><p>s</p></article>", "long words " * 30 + "s"),
    ("<div class='page with-sidebar'><main class=content><p>x</p></main></div>", "x"),
    ("<p>" + "long words here " * 20 + "</p><ul><li><a href=x>l</a></li></ul>", ("long words here " * 20).strip()),
])
def test_main_text(page, want):
    assert htmltext.main_text(page) == want


def test_main_text_without_article():
    words = [f"para{i} " * 40 for i in range(12)]
    blocks = "".join(f"<p>{w}</p>" for w in words)
    long_block = "<div>" + "huge block " * 1800 + "</div>"
    for page in (blocks + long_block, long_block + blocks, "<ul><li><a href=x>l</a></li></ul>" + blocks[:2000] + long_block + blocks):
        assert all(w.strip() in htmltext.main_text(page) for w in words)
    got = htmltext.main_text(f"<div class=post><p>teaser</p></div><ul><li><a href=x>some link</a></li></ul>{blocks}")
    assert "some link" not in got and all(w.strip() in got for w in words)


def test_surge_and_dive():
    lines = [htmltext.Line("x", n, 0, 0, False) for n in (0, 2, 0, 80, 90, 0, 70, 0, 0, 0, 3)]
    assert htmltext.window_sums(lines) == [2, 82, 170, 170, 160, 70, 70, 0, 3, 3, 3]
    assert htmltext.stretches(lines) == [(3, 7)]
    parted = [htmltext.Line("x", 100, i // 2, 0, False) for i in range(6)]
    assert htmltext.window_sums(parted) == [200, 100] * 3 and htmltext.stretches(parted) == [(0, 2), (2, 4), (4, 6)]
    assert htmltext.stretches([]) == []


@pytest.mark.parametrize("part, times", [("<div x='", 125_000), ("<", 500_000), ('<a b="', 150_000), ("<div>", 200_000), ("</div>", 160_000), ("<!--", 250_000),
                                         ("<p hidden><li hidden>", 50_000), ("<script>", 120_000), ("<div class=comment><article>", 35_000), ("&", 1_000_000)])
def test_hostile_pages_take_linear_time(part, times):
    import time

    began = time.process_time()
    for page in (part * times, part * times + ">", "<div>" * 50_000 + part * (times // 4) + "</section>" * 50_000):
        htmltext.main_text(page)
    assert time.process_time() - began < 6


def test_extract_through_spark(spark):
    pages = [(1, "u", "<article><p>a b</p></article>", "t", 1), (1, "u", "<article><p>a b</p></article>", "t", 1), (2, None, None, "t", 1), (None, "v", "", "t", 1),
             (3, "w", "<p>" + "long &amp; " * 100_000, "t", 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string, n_chars int")
    got = sorted((str(r.page_id), r.url, r.text, r.n_chars) for r in htmltext.extract(df).collect())
    long = ("long & " * 100_000).strip()
    assert got == [("1", "u", "a b", 3), ("1", "u", "a b", 3), ("2", None, "", 0), ("3", "w", long, len(long)), ("None", "v", "", 0)]
    assert htmltext.extract(df.limit(0)).count() == 0


# --- packing ----------------------------------------------------------------------------------

def test_ids_are_those_of_the_tokenizers_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    ours = packing.tokenizer()
    texts = ["", " ", "a  b c d e f g h i", "x \n y z 's don't we'll 12 34 é ü \t q  ", " lead a b c d e", "a b\n\n c d e\t f\r\n g", "<|endoftext|> a <|endoftext|>", "a　b 1,2 !!! ??",
             "Ünd das ist, ein Test. " * 30]
    for text in texts:
        assert np.frombuffer(ours.ids(text), np.uint32).tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_ids_of_random_texts_with_every_space():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()] + [" "] * 20 + list("\u180e\u200b\u200c\u2060\ufeff")
    words = ["don't", "I'll", "a", "the", "été", "12", "x9", "...", "!", "'s", "s'", "日本", "😀", "_", "<|endoftext|>", "Ⅷ", "²", "\0"]
    rng = random.Random(16)
    texts = ["".join(rng.choice(spaces if rng.random() < 0.5 else words) for _ in range(rng.randint(0, 12))) for _ in range(100_000)]
    ours = packing.tokenizer()
    for text, found in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ours.ids(text), np.uint32).tolist() == found.ids, text


def test_pieces_by_brute_force(spark):
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rows = EDGE + [(70, "very long text " * 100_000, "a"), (71, "\rdon't\n \xa0 \xa0", "a"), (72, "w " * 2047, "a"), (72, "w " * 2047, "a")]
    want = []
    for i, text, _ in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048
        cuts = [0] * (first > 0) + list(range(first, len(ids), 2048))
        for k, a in enumerate(cuts):
            part = ids[a : cuts[k + 1] if k + 1 < len(cuts) else len(ids)]
            want.append((str(i), k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = [(str(r.id), r.piece, r.start, r.length, r.ids_crc32) for r in packing.pieces(docs_of(spark, rows)).collect()]
    assert sorted(got) == sorted(want)


def test_a_single_document_gives_way_to_two_that_fit_tighter():
    where, _ = packing.best_two_fit(np.array([1100, 950, 950, 1100]))
    assert where[1] == where[2] and len(set(where.tolist())) == 3


def test_best_two_fit_is_tight():
    rng = np.random.default_rng(11)
    n = rng.integers(1, 2049, 3000)
    where, offset = packing.best_two_fit(n)
    assert (where.max() + 1) <= math.ceil(n.sum() / 2048) * 1.05 + 1
    for b in range(where.max() + 1):
        mine = np.flatnonzero(where == b)
        at = 0
        for i in mine[np.argsort(offset[mine])]:
            assert offset[i] == at
            at += n[i]
        assert at <= 2048


def test_pieces_and_sequences(spark):
    rows = EDGE + [(i, "word " * (i * 7), "a") for i in range(20, 40)]
    got = packing.packed(docs_of(spark, rows)).collect()
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert 0 < r.length <= 2048
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.piece_lengths(5000) == [904, 2048, 2048] and packing.piece_lengths(4096) == [2048, 2048]
    assert packing.packed(docs_of(spark, [])).count() == 0


def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline

    df = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns, name


CLASH = "doc_id long, text string, source string, lang string, n_chars long, score int, row string, k1 string, n_lines int, copies int, piece int, id int, length int"


def test_pipeline_stages_of_nulls_repeats_clashing_names_and_empty_tables(spark):
    import corpus_pipeline

    extra = (None, 9, 1, "r", "k", 2, 3, 4, 5, 6)
    rows = [(i, t, s, *extra) for i, t, s in [*EDGE, (None, None, None), (None, None, None), (8, "same line one\nsame line two", "a"), (9, "same line one\nsame line two", "a")]]
    df = spark.createDataFrame(rows, CLASH)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, df.limit(0), SF).count() == 0, name
        out = stage(spark, df, SF)
        if name != "packing":
            assert out.columns == df.columns, name
            assert out.select("score", "row", "k1", "n_lines", "copies", "piece", "id", "length").distinct().collect() == [(1, "r", "k", 2, 3, 4, 5, 6)], name
        got = Counter((r.doc_id, r.text) for r in out.collect()) if name != "packing" else None
        if name == "toxicity":
            assert got == Counter((i, t) for i, t, *_ in rows)
        elif name == "line_dedup":
            assert got == Counter((i, "" if i == 9 else t) for i, t, *_ in rows)
        elif name == "simhash_near_dedup":
            assert sorted(t or "" for _, t in got.elements()) == sorted({"one two three four", "", "w " * 5000 + "end", EDGE[-1][1], "same line one\nsame line two"})
        elif name == "mixing":
            assert all(n <= 2 * Counter((i, t) for i, t, *_ in rows)[k] for k, n in got.items())
        else:
            assert {r.doc_id for r in out.collect()} == {i for i, *_ in rows} and out.agg({"length": "sum"}).first()[0] > 5000


def test_pipeline_run_applies_its_stages_in_turn(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, f"text {i} " + " ".join(f"w{(i * k) % 89}" for k in range(60)), "ab"[i % 2]) for i in range(40)] + EDGE
    df = spark.createDataFrame([(i, t, s, "en", len(t or "")) for i, t, s in rows], "doc_id long, text string, source string, lang string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 0) for i in range(20)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    want = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        want = spark.createDataFrame(stage(spark, want, str(tmp_path)).collect(), schema=stage(spark, want, str(tmp_path)).schema)
    fields = ("doc_id", "piece", "start", "length", "ids_crc32")
    of = lambda x: sorted(map(repr, x.select(*fields).collect()))
    assert of(corpus_pipeline.run(spark, str(tmp_path))) == of(want)


def test_one_of_each_keeps_one_row_of_every_component(spark):
    rows = EDGE + [(1, "five six seven eight", "a"), (9, "five six seven eight", "a"), (None, "alone and far away", "a"), (None, "another one elsewhere", "a")]
    out = simhash.one_of_each(docs_of(spark, rows))
    assert out.columns == docs_of(spark, []).columns
    got = sorted((str(r.doc_id), r.text or "") for r in out.collect())
    want = [("1", "five six seven eight"), ("1", "one two three four"), ("2", ""), ("5", "w " * 5000 + "end"), ("6", EDGE[-1][1]),
            ("None", "alone and far away"), ("None", "another one elsewhere")]
    assert got == sorted(want)


def five_words(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("pairwise, stars, rounds", [(32, 3, 10), (2, 1, 10), (2, 0, 1), (32, 0, 0)])
def test_pipeline_drops_near_copies_by_brute_force(spark, monkeypatch, pairwise, stars, rounds):
    import corpus_pipeline
    from tabulon.llm import nearcopies

    monkeypatch.setattr(nearcopies, "PAIRWISE", pairwise)
    monkeypatch.setattr(nearcopies, "STAR_ROUNDS", stars)
    monkeypatch.setattr(nearcopies, "PIVOT_ROUNDS", rounds)
    rng = random.Random(12)
    rows = [*EDGE]
    for i in range(10, 40):
        t = [f"w{rng.randrange(2000)}" for _ in range(rng.choice([60, 200, 400]))]
        rows.append((i, " ".join(t), "a"))
        for k in range(1, 7):  # from close copies to ones below the bound
            u = list(t)
            for at in rng.sample(range(len(t)), max(1, len(t) * k // 200)):
                u[at] = f"x{rng.randrange(2000)}"
            rows.append((rng.choice([None, i + 100 * k]), " ".join(u), "a"))
    kept = corpus_pipeline.drop_near_duplicates(spark, docs_of(spark, rows), SF).collect()
    kept = [(r.doc_id, r.text) for r in kept]
    jac = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    sets = [(i, t, five_words(t)) for i, t in {(i, t) for i, t, _ in rows}]
    stay = [five_words(t) for _, t in kept]
    assert sum(jac(a[2], b[2]) >= 0.8 for n, a in enumerate(sets) for b in sets[:n]) > 100
    assert all(jac(a, b) < 0.8 for n, a in enumerate(stay) for b in stay[:n])
    for i, t, s in sets:
        if (i, t) not in kept:  # what goes is near another one, of no larger id
            assert any((j, u) != (i, t) and jac(s, v) >= 0.8 and (j is not None or i is None) and (i is None or j <= i) for j, u, v in sets)


def test_pipeline_drops_by_simhash_and_then_by_exact_check(spark):
    """Two texts of one fingerprint whose word shingles differ: only SimHash takes them for copies."""
    import corpus_pipeline

    rows = [(i, "x " * 60 + tail, "a") for i, tail in enumerate(("a b c", "d e f"))] + [(2, "another text of quite different words here", "a")]
    assert simhash.fingerprint(rows[0][1]) == simhash.fingerprint(rows[1][1])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs_of(spark, rows), SF).collect()
    assert sorted(r.doc_id for r in kept) == [0, 2]


def test_a_step_updates_its_dense_weights_as_one_vector_by_the_plain_rule():
    import numpy as np

    from tabulon.llm import attention

    rng = np.random.default_rng(3)
    ids, wanted, valid = rng.integers(0, 50, (4, attention.WINDOW)), rng.integers(0, attention.CLASSES, (4, attention.WINDOW)), rng.random((4, attention.WINDOW)) < 0.9
    first = attention.fresh()
    trainer = attention.Trainer(first, rate=0.1)
    trainer.step(ids, wanted, valid)
    assert all(np.shares_memory(trainer.w[n], trainer.w["out"].base) for n in ("pos", "qkv", "o", "out", "bias"))

    def loss(name, at, by):
        moved = {n: a.astype(np.float64) for n, a in first.items()}
        moved[name][at] += by
        return -attention.class_log_probs(moved, ids, valid, wanted[valid]).mean()

    for name, at in (("pos", (3, 2)), ("qkv", (1, 40)), ("o", (2, 5)), ("out", (4, 7)), ("bias", (int(wanted[valid][0]),)), ("emb", (int(ids[0, 1]), 3))):
        g = (loss(name, at, 1e-3) - loss(name, at, -1e-3)) / 2e-3
        step = 0.1 * g / np.sqrt(1e-6 + g * g)
        assert abs(first[name][at] - trainer.w[name][at] - step) < 2e-3, name


def test_packed_words_are_those_of_equal_ids():
    ids = [[0], [0, 0], [0, 0, 0, 0], [0, 0, 0, 0, 0], [5, 50256], [5], [50256, 5, 1], [0, 0, 0, 0, 1]]
    raw, size = b"".join(np.array(x, np.uint16).tobytes() for x in ids), np.array(list(map(len, ids)))
    got = lmscore._packed(raw, np.cumsum(size) - size, size)
    assert got.tolist() == [int.from_bytes(np.array(x[:4], np.uint16).tobytes().ljust(8, b"\xff"), "little") for x in ids]
    assert len(set(got[size <= lmscore.SHORT].tolist())) == (size <= lmscore.SHORT).sum()
