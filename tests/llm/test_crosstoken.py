"""Cross-tokenizer alignment against brute force over all tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from conftest import SF

from tabulon.llm import crosstoken

DOCS = "doc_id long, text string, batch string, n_a int, block int"
EDGE = [(1, "one two  three\nfour", "a", 1, 1), (2, None, "b", 1, 1), (3, "", None, 1, 1), (4, "  lead and trail \t ", "a", 1, 1), (None, "one two  three\nfour", "a", 1, 1), (1, "one two  three\nfour", "a", 1, 1),
        (5, "word " * 30000 + "end", "a", 1, 1), (6, "naïve ÄÖ 漢字 🙂 x y ▁ z", "b", 1, 1), (7, "</s> <s> <|endoftext|> <0x41>", "b", 1, 1), (8, "a▁b", "b", 1, 1), (9, " ", "b", 1, 1), (10, "x\x00y z", "b", 1, 1), (11, "🙂🙂 đđ ﬁn", "b", 1, 1)]


def brute(rows):
    """The contract's columns by plain loops over whole texts, with the tokenizers file's own encoder."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}

    def b_bytes(i):
        p = b_model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and p.endswith(">") and len(p) == 6 else p.replace("▁", " ").encode()

    held, out = defaultdict(set), []
    for at, (doc, text) in enumerate(rows):
        a = [(i, bytes(byte_of[c] for c in a_model.id_to_token(i))) for i in a_model.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = [(i, b_bytes(i)) for i in b_model.encode(text)] if text else []
        own = (" " + text).encode() if text else b""
        if not text or b"".join(x for _, x in a) != own or b"".join(x for _, x in b) != own:
            out.append((doc, 0, 0, 0, Counter(), ""))
            continue
        places = []
        for side in (a, b):
            end, spans = 0, []
            for i, x in side:
                spans.append((i, end, end + len(x)))
                end += len(x)
            places.append(spans)
        of_byte = [[i for i, (_, s, e) in enumerate(spans) for _ in range(s, e)] for spans in places]
        linked = sorted({(x, y) for x, y in zip(*of_byte)})
        ends = sorted({e for _, _, e in places[0]} & {e for _, _, e in places[1]})
        groups, begin = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in spans if begin <= s and e <= end) for spans in places) if len(own) < 3000 else "")
            begin = end
        pairs = Counter((places[0][x][0], places[1][y][0]) for x, y in linked)
        for p in pairs:
            held[p].add(at)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if len(own) < 3000 else None
        out.append((doc, len(a), len(b), len(ends), pairs, digest))
    most = defaultdict(int)
    for (a, _), docs in held.items():
        most[a] = max(most[a], len(docs))
    return [(doc, n_a, n_b, n, sum(pairs.values()), sum(k for p, k in pairs.items() if len(held[p]) == most[p[0]]), sum(k * len(held[p]) for p, k in pairs.items()), digest)
            for doc, n_a, n_b, n, pairs, digest in out]


def same(got, want):
    got = sorted(map(tuple, got), key=repr)
    want = sorted(want, key=lambda r: repr(r[:-1]))
    assert [r[:-1] for r in sorted(got, key=lambda r: repr(r[:-1]))] == [r[:-1] for r in want]
    known = {repr(r[:-1]): r[-1] for r in want}
    assert all(known[repr(r[:-1])] in (None, r[-1]) for r in got)


def test_edge_cases(spark):
    out = crosstoken.cross_tokens(spark.createDataFrame(EDGE, DOCS).repartition(3)).collect()
    same(out, brute([r[:2] for r in EDGE]))
    assert {r.id for r in out if not r.n_links} >= {2, 3, 8}


@pytest.mark.parametrize("blocks,stripes", [(256, 16), (7, 3)])
def test_random_texts(spark, blocks, stripes):
    rnd = random.Random(blocks)
    rows = [(k, "".join(rnd.choice(["the ", "of", " ", "ing", "é", "\n", "word", "漢", "x1 ", "▁", "  "]) if rnd.random() < 0.98 else "▁" for _ in range(rnd.randint(0, 60))).replace("▁", "" if k % 9 else "▁")) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    same(crosstoken.cross_tokens(docs, blocks=blocks, stripes=stripes).collect(), brute(rows))


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    same(crosstoken.query(spark, SF).collect(), brute(rows))


def test_empty_table(spark):
    assert crosstoken.cross_tokens(spark.createDataFrame([], DOCS)).count() == 0
