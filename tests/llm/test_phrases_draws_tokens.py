"""Phrase collocations, importance resampling and chunked byte-level encoding against brute force and the tokenizers library."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from forumlens.llm import chunked_bpe, hat_trie, importance, queries
from forumlens.llm.text import words_of

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, n long, a long, score long, rank long, ids string, _row long, decoded string"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are absent")
needs_tokenizer = pytest.mark.skipif(not os.path.exists(chunked_bpe.TOKENIZER), reason="the tokenizer file is absent")


def docs(spark, rows):
    """Documents (id, text, lang) with columns that clash with the operators' own names."""
    return spark.createDataFrame([(i, t, g, 1, 2, 3, 4, "x", 5, "y") for i, t, g in rows], DOCS)


def awkward():
    rng = random.Random(5)
    word = lambda: rng.choice(["the", "of", "Zoë", "x1", "a'b", "Ñu", "日本"]) if rng.random() < 0.7 else f"w{rng.randrange(60)}"
    rows = [(i, "".join(word() + rng.choice([" ", " ", " ", "\t", ". ", "\n", ", ", "  "]) for _ in range(rng.randrange(0, 120))),
             rng.choice(["en", "en", "en", "de", None])) for i in range(60)]
    rows += [(100, None, "en"), (101, "", None), (102, "...,,\n\r ", "en"), (103, "of the of the of the " * 3000, "en")]
    rows += [rows[3], rows[3], (None, rows[4][1], "en"), (7, rows[5][1], "de")]  # repeated rows, no id, an id met twice
    return rows


def phrases(rows, least, first):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", folded):
            ws = re.findall("[^ \t]+", piece)
            totals[lang] += len(ws)
            for n in (1, 2, 3):
                counts[lang].update(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        listed = []
        for p, a in found.items():
            if any(len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * b >= 50 * a for q, b in found.items()):
                continue
            s, _, l, r = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            listed.append((-s, -a, " ".join(p).encode(), l, r))
        for k, (s, a, p, l, r) in enumerate(sorted(listed)[:first]):
            out.append((lang, k + 1, p.decode(), -a, l, r, totals[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("trie", [{}, {"entries": 50, "burst": 4}])
def test_phrases_equal_brute_force_also_when_spilling(spark, trie):
    rows = awkward()
    got = hat_trie.collocations(docs(spark, rows), 4, 30, 1 << 12, **trie)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == phrases(rows, 4, 30)


def test_phrases_score_beyond_64_bits(spark):
    """A filter of few bits lets everything through; counts of billions would overflow a long when squared."""
    frame = spark.createDataFrame([(3_000_000_000, 4_000_000_000, 3_500_000_000)], "a long, l long, r long")
    assert frame.select(hat_trie._score("l", "r")).first()[0] == 1000000 * 3_000_000_000**2 // (4_000_000_000 * 3_500_000_000)
    rows = awkward()
    assert sorted(map(tuple, hat_trie.collocations(docs(spark, rows), 4, 30, 64).collect())) == phrases(rows, 4, 30)


def test_phrases_of_nothing(spark):
    assert hat_trie.collocations(docs(spark, [])).collect() == []
    assert hat_trie.collocations(docs(spark, [(1, None, None), (2, "", "en")])).collect() == []


def test_trie_bursts_and_spills_whole_subtrees():
    trie = hat_trie.HatTrie(burst=8)
    rng = random.Random(1)
    keys = sorted({(rng.randrange(1, 4) << 42) | (rng.randrange(1, 9) << 21) | rng.randrange(9) for _ in range(300)})
    for part in (keys[::2], keys[1::2], keys):
        trie.add(np.array(part, dtype=np.int64), np.ones(len(part), dtype=np.int64))
    assert trie.entries == len(keys) and any(isinstance(t, hat_trie._Node) for t in trie.root.values())
    spilled = [dict(zip(k.tolist(), n.tolist())) for k, n in trie.spill(len(keys) // 2)]
    assert trie.entries <= len(keys) // 2
    gone = {k >> 42 for part in spilled for k in part}
    assert gone.isdisjoint(trie.root)
    rest = [dict(zip(k.tolist(), n.tolist())) for k, n in trie.spill(0)]
    assert {k: n for part in spilled + rest for k, n in part.items()} == dict.fromkeys(keys, 2)


def drawn(rows, target, per_cent=5, least=20):
    def features(text):
        ws = words_of(text)
        return len(ws), [zlib.crc32(b" ".join(ws[i : i + n])) % 10000 for n in (1, 2, 3) for i in range(len(ws) - n + 1)]

    found = [(i, *features(t)) for i, t, _ in rows]
    s, t = collections.Counter(), collections.Counter()
    for _, _, f in found:
        s.update(f)
    for text in target:
        t.update(features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {k: math.floor(1000 * math.log((t[k] + 1) * (big_s + 10000) / ((s[k] + 1) * (big_t + 10000)))) for k in s}
    scored = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[k] for k in f)
        scored.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n, None])
    order = sorted((x for x in scored if x[4] >= least), key=lambda x: (-x[3], x[0] is not None, x[0] or 0))
    for k, x in enumerate(order[: per_cent * len(order) // 100]):
        x[5] = k + 1
    return sorted((tuple(x[:4]) + (x[5],) for x in scored), key=repr)


TARGET = ["the of Zoë x1 w3 w4", None, "", "w" * 80 + " of the " + "q" * 70]


@pytest.mark.parametrize("per_cent", [0, 5, 40, 100])
def test_draw_equals_brute_force(spark, per_cent):
    rows = awkward() + [(200, ("w" * 80 + " ") * 30, "en"), (201, "of the " + "q" * 70 + " of" * 40, "en")]
    target = spark.createDataFrame([(t, 1) for t in TARGET], "text string, score long")
    got = importance.resample(docs(spark, rows), target, per_cent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == drawn(rows, TARGET, per_cent)


def test_draw_of_nothing(spark):
    target = spark.createDataFrame([], "text string")
    assert importance.resample(docs(spark, []), target).collect() == []
    assert [r["rank"] for r in importance.resample(docs(spark, [(1, "a b", "en"), (2, None, "en")]), target).collect()] == [None, None]


@pytest.mark.parametrize("score", ["id % 7", "0", "id * id", "-abs(id - 500)", "pow(id, 5)"])
def test_cutoff_is_exact_whatever_the_sketch_says(spark, score):
    frame = spark.range(1000).selectExpr("id AS doc_id", f"CAST({score} AS long) AS score").repartition(3)
    order = sorted(((r["score"], r["doc_id"]) for r in frame.collect()), key=lambda r: (-r[0], r[1]))
    for n in (1, 50, 999, 1000):
        assert importance.cutoff(frame, n, 1000) == order[n - 1]
    assert importance.cutoff(frame, 300, 1000, margin=-2500) == order[299]  # a bracket beside the cutoff widens


def test_crc_of_runs():
    texts = ["a b c", "", None, "x" * 200 + " y " + "z" * 63 + " " + "z" * 64, "Zoë 日本"]
    crcs, owner, n_words = importance.features(texts)
    want = collections.Counter()
    for k, t in enumerate(texts):
        ws = words_of(t)
        want.update((k, zlib.crc32(b" ".join(ws[i : i + n]))) for n in (1, 2, 3) for i in range(len(ws) - n + 1))
    assert collections.Counter(zip(owner.tolist(), crcs.tolist())) == want
    assert n_words.tolist() == [3, 0, 0, 4, 2]


def token_texts():
    rng = random.Random(9)
    base = ["".join(rng.choice(["'", " ", "  ", "\n", "ll", "s", "é", "1", "!", "a", "日", "re", "\t", " ", "\x1c"]) for _ in range(rng.randrange(1, 5000)))
            for _ in range(12)]
    shared = " ".join(f"word{rng.randrange(999)}" for _ in range(900))
    base += [f"start {k} {shared} end {k}" for k in range(150)]  # chunks in many rows of one batch
    base += ["", None, "x" * 30000, "aé" * 5000, " " * 9000, "'t" * 6000, "<|endoftext|>hi<|endoftext|><|endoftext|> there", "\U00011b00՘a1½Ⅷ", shared, shared]
    return base


@needs_tokenizer
def test_ids_equal_the_librarys(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(chunked_bpe.TOKENIZER)
    texts = token_texts()
    frame = docs(spark, [*((k, t, None) for k, t in enumerate(texts)), (None, "no id", None), (3, texts[3], None)]).repartition(3)
    coded = chunked_bpe.decode(chunked_bpe.encode(frame, ["doc_id", "n", "_row"]))
    assert coded.columns == ["doc_id", "n", "_row", "ids", "decoded"]
    got = coded.collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = "no id" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        assert chunked_bpe.unpacked(r["ids"]) == library.encode(text, add_special_tokens=False).ids
        assert r["decoded"] == text == library.decode(chunked_bpe.unpacked(r["ids"]), skip_special_tokens=False)
    assert chunked_bpe.encode(docs(spark, []), ["doc_id"]).collect() == []


@needs_tokenizer
def test_chunks_are_shared_and_joins_mended():
    t = chunked_bpe.load(chunked_bpe.TOKENIZER)
    shared = " ".join(f"word{(k * k) % 997}" for k in range(2000)).encode()
    cuts = [shared[:0] + b"one " + shared, b"another beginning, " + shared]
    parts = []
    for raw in cuts:
        ends = chunked_bpe.ends_of_chunks(raw)
        assert b"".join(raw[a:z] for a, z in zip([0, *ends], ends)) == raw
        assert all(z - a <= chunked_bpe.MOST + 3 for a, z in zip([0, *ends], ends))
        parts.append({raw[a:z] for a, z in zip([0, *ends], ends)})
    assert len(parts[0] & parts[1]) > 0.7 * len(parts[0])
    # Wrong joins happen, and are mended.
    raw = cuts[0]
    ends = chunked_bpe.ends_of_chunks(raw)
    naive, joiner = b"", chunked_bpe._Joiner(t)
    for a, z in zip([0, *ends], ends):
        ids, marks = t.chunk(raw[a:z].decode())
        naive += ids
        joiner.add(ids, marks)
    joiner.close()
    assert b"".join(joiner.ids) == t.encode(raw.decode()) != naive


@needs_tables
@needs_tokenizer
def test_token_query_equals_the_library_on_whole_texts(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(chunked_bpe.TOKENIZER)
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    got = queries.op13_byte_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
