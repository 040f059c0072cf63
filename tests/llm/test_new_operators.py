"""SimHash, vector codes and token alignment against plain Python over whole texts and all pairs."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from checks import compare
from tidemark.llm import align, codes, queries, simhash, sql
from tidemark.llm.common import table
from tidemark.llm.links import components

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def joined_labels(n, pairs):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return [root(x) for x in range(n)]


# SimHash


def plain_fingerprint(text, width=3):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    if not words:
        return 0
    spans = [" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = [None, "", " \t\n", "one", "One two", "one  TWO", "a b c", "a b c a b c a b c", "É Ünï 漢字 x", "x\x1cy z", "x\x1cy z w " * 700]


def test_fingerprints_follow_the_definition():
    for text in TEXTS:
        assert simhash.fingerprint(text) == plain_fingerprint(text), text


def test_fingerprint_of_a_text_longer_than_one_part():
    rng = np.random.default_rng(3)
    text = " ".join(map(str, rng.integers(0, 10**9, 70_000)))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_has_the_same_shingle_hash(spark):
    (row,) = spark.sql("SELECT xxhash64('a b c') AS h").collect()
    assert row["h"] % 2**64 == xxhash.xxh64_intdigest(b"a b c", seed=42)


def brute_links(bits, most):
    bits = np.array([b % 2**64 for b in bits], np.uint64)
    for i in range(len(bits)):
        for j in np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= most):
            yield i, i + 1 + int(j)


def test_simhash_query_equals_all_pairs(spark):
    docs = sorted(((r["doc_id"], r["text"]) for r in table(spark, SF2, "documents").collect()))
    bits = [plain_fingerprint(t) for _, t in docs]
    roots = joined_labels(len(docs), brute_links(bits, 3))
    wanted = {d: (f"{b:016x}", docs[r][0]) for (d, _), b, r in zip(docs, bits, roots, strict=True)}
    got = queries.op11_simhash(spark, SF2).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == wanted
    assert len(got) == len(docs) and len(set(roots)) < len(docs)


@pytest.mark.parametrize("block", [1000, 7])
@pytest.mark.parametrize("most", [3, 2, 0])
def test_dense_clusters_in_few_buckets(spark, monkeypatch, block, most):
    """Fingerprints few bits from three centres, two of which share a segment; blocks smaller than a bucket."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(11)
    centres = [0x0123456789ABCDEF, 0x01234567FEDCBA98, 0xFFFFFFFF00000000]
    bits = set()
    for c in centres:
        for _ in range(120):
            flips = rng.choice(64, rng.integers(0, 9), replace=False)
            bits.add(c ^ sum(1 << int(f) for f in flips))
    bits = sorted(bits)
    signed = [b - 2**64 if b >= 2**63 else b for b in bits]
    nodes = spark.createDataFrame([(b,) for b in signed], "bits bigint")
    found = simhash._links(simhash._table(nodes), simhash._looked_up(nodes), most).collect()
    place = {b: k for k, b in enumerate(signed)}
    links = [(place[r["a"]], place[r["b"]]) for r in found]
    assert all((bits[a] ^ bits[b]).bit_count() <= most for a, b in links)
    assert joined_labels(len(bits), links) == joined_labels(len(bits), brute_links(bits, most))


def test_every_pair_up_to_three_bits_shares_a_bucket(spark):
    rng = np.random.default_rng(2)
    rows, pairs = [], []
    for k in range(300):
        a = int(rng.integers(0, 2**63))
        flips = rng.choice(64, k % 4, replace=False)
        b = a ^ sum(1 << int(f) for f in flips)
        pairs.append((a, b - 2**64 if b >= 2**63 else b))
    rows = sorted({x for p in pairs for x in p})
    nodes = spark.createDataFrame([(x,) for x in rows], "bits bigint")
    links = simhash._links(simhash._table(nodes), simhash._looked_up(nodes), 3)
    label = {r["node"]: r["label"] for r in components(links).collect()}
    assert all(a == b or label[a] == label[b] for a, b in pairs)


def test_simhash_broadcasts_no_table_that_grows(spark, monkeypatch):
    """Not even small ones: the size of an exploded table is one that Spark doesn't know. A row per component may go."""
    plans, write = {}, simhash.staged

    def recorded(df, name="staged"):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(simhash, "staged", recorded)
    df = spark.createDataFrame([(k, f"words of text {k // 2}") for k in range(50)], "doc_id bigint, text string")
    found = simhash.near_duplicates(df)
    plans["found"] = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plans["hits"]
    assert [n for n, plan in plans.items() if "Broadcast" in plan and n != "owners"] == []
    assert sorted((r["doc_id"], r["component_id"]) for r in found.collect()) == [(k, k // 2 * 2) for k in range(50)]


def test_simhash_of_null_ids_and_empty_texts(spark):
    rows = [(None, "same words here"), (None, "same words here"), (9, ""), (8, None), (7, "  "), (2**60 + 1, "same words here"), (5, "other text of words")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "text AS bits", "1 AS bucket", "2 AS label", "3 AS component_id")
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=str)
    same = f"{plain_fingerprint('same words here'):016x}"
    other = f"{plain_fingerprint('other text of words'):016x}"
    wanted = [(None, same, 2**60 + 1)] * 2 + [(2**60 + 1, same, 2**60 + 1), (5, other, 5)] + [(d, "0" * 16, 7) for d in (7, 8, 9)]
    assert got == sorted(wanted, key=str)
    lone = simhash.near_duplicates(spark.createDataFrame([(None, "a b c d")], "doc_id bigint, text string")).collect()
    assert [(r["doc_id"], r["component_id"]) for r in lone] == [(None, None)]


# Vector codes


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """``rows`` are (id, whole numbers) in order of ids; codes, errors and codebooks."""
    width = len(rows[0][1]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, v in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def best(p, part):
        return min((sum((x - y) ** 2 for x, y in zip(part, entry, strict=True)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        after = [list(b) for b in books]
        for p in range(parts):
            members = defaultdict(list)
            for c in cut:
                members[best(p, c[p])[1]].append(c[p])
            for e, found in members.items():
                after[p][e] = tuple(math.floor(sum(xs) / len(xs)) for xs in zip(*found, strict=True))
        books = after
    out = [[best(p, c[p]) for p in range(parts)] for c in cut]
    digest = hashlib.sha256(",".join(str(x) for b in books for entry in b for x in entry).encode()).hexdigest()
    return [("".join(f"{e:02x}" for _, e in o), sum(d for d, _ in o)) for o in out], digest


@pytest.mark.parametrize("run", [1, 2, 5, 4096])
def test_walk_of_the_trie_gives_the_nearest_entries(run):
    rng = np.random.default_rng(run)
    for depth, spread in ((1, 3), (2, 2), (4, 3), (4, 200)):
        leaves = np.unique(rng.integers(-spread, spread, (300, depth)), axis=0)
        entries = rng.integers(-spread, spread, (9, depth))
        distance = ((leaves[:, None] - entries[None]) ** 2).sum(axis=2)
        which, least = codes.nearest(leaves, entries, run)
        assert (which == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()


def test_distinct_parts_come_back():
    part = np.array([[2, 1], [-1, 5], [2, 1], [2, 0], [-1, 5], [2, 1]])
    leaves, number, weight = codes.distinct_parts(part)
    assert leaves.tolist() == [[-1, 5], [2, 0], [2, 1]] and weight.tolist() == [2, 1, 3]
    assert (leaves[number] == part).all()


@pytest.mark.parametrize("block", [64, 1 << 15])
def test_codes_equal_plain_python(spark, monkeypatch, block):
    monkeypatch.setattr(codes, "BLOCK", block)
    df = table(spark, SF, "embeddings")
    rows = sorted((r["vec_id"], [math.floor(256 * x) for x in r["embedding"]], r["label"]) for r in df.collect())
    wanted, digest = plain_codes([r[:2] for r in rows])
    by_label = Counter()
    for (_, _, label), (_, error) in zip(rows, wanted, strict=True):
        by_label[label] += error
    got = {r["vec_id"]: r for r in queries.op12_vector_codes(spark, SF).collect()}
    assert {k: (r["code"], r["error"]) for k, r in got.items()} == {r[0]: w for r, w in zip(rows, wanted, strict=True)}
    assert all(got[r[0]]["label_error"] == by_label[r[2]] and got[r[0]]["codebooks_sha256"] == digest for r in rows)


NAN, INF = float("nan"), float("inf")
VECTORS = [
    (1, [0.1, -0.2, 0.3, -0.004], 1), (1, [0.1, -0.2, 0.3, -0.004], 1), (2, None, 1), (3, [], 2), (4, [0.5, None, 0.1, 0.1], 1),
    (5, [NAN, 0.0, 0.0, 0.0], 1), (6, [INF, 0.0, 0.0, 0.0], 1), (7, [-INF, 0.0, 0.0, 0.0], None), (8, [0.1, 0.2], 2),
    (None, [1.0, 1.0, 1.0, 1.0], None), (9, [-0.5, 0.25, 0.0, 3.0e5], None), (10, [0.1, 0.2, 0.3, 0.4, 0.5], 2),
]


def test_codes_of_odd_vectors(spark):
    df = spark.createDataFrame(VECTORS, "vec_id bigint, embedding array<float>, label int")
    df = df.selectExpr("*", "label AS of", "vec_id AS code", "vec_id AS ints", "label AS values", "label AS error", "label AS label_error")
    got = codes.compress(df, parts=2, entries=2, rounds=2).collect()
    whole = [(k, [math.floor(256 * float(np.float32(x))) for x in v]) for k, v, _ in VECTORS if k in (1, 9, None) and v]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    wanted, digest = plain_codes(whole, 2, 2)
    found = sorted(((r["vec_id"], r["code"], r["error"]) for r in got), key=str)
    unfit = [(k, None, None) for k in (3, 8, 10)]
    assert found == sorted([(k, c, e) for (k, _), (c, e) in zip(whole, wanted, strict=True)] + unfit, key=str)
    assert {r["codebooks_sha256"] for r in got} == {digest}
    errors = {k: e for (k, _), (_, e) in zip(whole, wanted, strict=True)}
    assert {r["label_error"] for r in got if r["vec_id"] in (None, 9)} == {errors[None] + errors[9]}
    assert {r["label_error"] for r in got if r["label"] == 2} == {None}
    assert codes.compress(df.where("false")).collect() == []
    none_fits = codes.compress(df.where("vec_id = 3"), parts=2).collect()
    assert [(r["vec_id"], r["code"]) for r in none_fits] == [(3, None)]


def test_huge_components_stop_at_the_limit(spark):
    df = spark.createDataFrame([(1, [3.0e38] * 64, 0), (2, [-3.0e38] * 64, 0), (3, [0.0] * 64, 0)], "vec_id int, embedding array<float>, label int")
    got = {r["vec_id"]: r["error"] for r in codes.compress(df, entries=1, rounds=0).collect()}
    assert got == {1: 0, 2: 64 * 4 * codes._largest(64) ** 2, 3: 64 * codes._largest(64) ** 2} and got[2] < 2**63


def test_codes_with_nulls_equal_their_sql(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = [(int(k), [float(x) for x in rng.normal(0, 0.2, 64)], int(rng.integers(0, 4)) if k % 5 else None) for k in rng.permutation(150)]
    for k in range(0, 150, 10):
        rows[k] = (rows[k][0], None if k % 20 else [*rows[k][1][:-1], NAN], rows[k][2])
    rows += [(1000 + k, rows[k][1], 1) for k in range(20)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    df.coalesce(1).write.parquet(str(tmp_path / "embeddings"))
    con = compare.connect(SF)
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings/*.parquet'")
    result = con.sql(sql.vector_codes(16, 64, 2))
    got = codes.compress(df).drop("label")
    assert compare._rows(got.columns, got.collect()) == compare._rows(result.columns, result.fetchall())


# Token alignment


class Plain:
    """Both tokenizers by their own libraries, and the bytes of a token by the rules of its vocabulary."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        unseen = [b for b in range(256) if b not in seen]
        self.letters = {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(unseen)}
        self.of_a, self.of_b = cache(self.bytes_of_a), cache(self.bytes_of_b)

    def bytes_of_a(self, number):
        return bytes(self.letters[c] for c in self.a.id_to_token(number))

    def bytes_of_b(self, number):
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()


@pytest.fixture(scope="module")
def tokenizers():
    return Plain()


def plain_alignment(texts, tokenizers):
    """Whole texts, links as all pairs of byte ranges that overlap."""
    rows, linked = {}, {}
    for doc, text in texts:
        rows[doc], linked[doc] = (0, 0, 0, 0, ""), []
        if not text:
            continue
        ids_a, ids_b = tokenizers.a.encode(" " + text, add_special_tokens=False).ids, tokenizers.b.encode(text)
        bytes_a, bytes_b = list(map(tokenizers.of_a, ids_a)), list(map(tokenizers.of_b, ids_b))
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            continue
        ranges = []
        for tokens in (bytes_a, bytes_b):
            ends = list(itertools.accumulate(map(len, tokens)))
            ranges.append(list(zip([0, *ends[:-1]], ends, strict=True)))
        found, low = [], 0
        for i, (start, end) in enumerate(ranges[0]):
            while ranges[1][low][1] <= start:
                low += 1
            j = low
            while j < len(ids_b) and ranges[1][j][0] < end:
                found.append((ids_a[i], ids_b[j]))
                j += 1
        both = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
        groups = []
        for start, end in zip([0, *both[:-1]], both, strict=True):
            sides = [",".join(str(k) for k, (s, _) in zip(ids, r, strict=True) if start <= s < end) for ids, r in ((ids_a, ranges[0]), (ids_b, ranges[1]))]
            groups.append("|".join(sides))
        linked[doc] = found
        rows[doc] = (len(ids_a), len(ids_b), len(groups), len(found), hashlib.sha256(";".join(groups).encode()).hexdigest())
    counts = Counter(p for found in linked.values() for p in found)
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = {}
    for doc, (n_a, n_b, n_groups, n_links, digest) in rows.items():
        best = sum(counts[p] == top[p[1]] for p in linked[doc])
        out[doc] = (n_a, n_b, n_groups, n_links, best, sum(counts[p] for p in linked[doc]), digest)
    return out


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\nb", "a \n b", "<|endoftext|> x <|endoftext|>", "x<|endoftext|>", "<s> </s> <unk>", "<0x41> <0x0A>",
    "▁x", "x ▁ y", "Ünï cödé 漢字かな \U0001f600 é", "x\x1cy \x1c z　w    q", "\x00 \x01", "don't we'll I'M", "a" * 5000, "漢" * 3000, "word " * 3_000,
    "tab\there  two   three    four", "<s>", "\r\n\r\n x \t\t y", "ﬁ ligature Ⅷ ²",
]


def test_alignment_query_equals_whole_texts(spark, tokenizers):
    texts = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    wanted = plain_alignment(texts, tokenizers)
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in queries.op13_token_alignment(spark, SF).collect()}
    assert got == wanted and sum(w[0] > 0 for w in wanted.values()) > 0.8 * len(wanted)


@pytest.mark.parametrize(("links", "rows", "pieces"), [(1 << 18, 4096, 400_000), (50, 3, 10)])
def test_alignment_of_odd_texts_in_blocks_of_any_size(spark, tokenizers, monkeypatch, links, rows, pieces):
    for name, value in (("BLOCK_LINKS", links), ("BLOCK_ROWS", rows), ("PIECES", pieces)):
        monkeypatch.setattr(align, name, value)
    texts = [(2**60 + k, t) for k, t in enumerate(ODD + ["the cat sat on the mat"] * 9)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").selectExpr("*", "text AS block", "text AS pairs", "1 AS listed", "2 AS n_a")
    wanted = plain_alignment(texts, tokenizers)
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in align.align(df, *queries.tokenizer_files()).collect()}
    assert got == wanted


def test_alignment_of_null_and_repeated_ids(spark, tokenizers):
    texts = ["some words here", "some words here", "other", None]
    df = spark.createDataFrame([(None, texts[0]), (1, texts[1]), (1, texts[2]), (None, None)], "doc_id int, text string")
    wanted = sorted(plain_alignment(list(enumerate(texts)), tokenizers).values())
    rows = align.align(df, *queries.tokenizer_files()).collect()
    assert sorted(tuple(r[n] for n in NAMES) for r in rows) == wanted
    assert sorted(str(r["doc_id"]) for r in rows) == ["1", "1", "None", "None"]
    assert align.align(df.where("false"), *queries.tokenizer_files()).collect() == []


def test_slices_and_links():
    assert align.slices([1, 3, 6], [3, 4, 6]) == ([3, 6], [2, 3], [1, 3])
    assert list(align.links([1, 3, 6], [3, 4, 6], (0, 2, 0, 1))) == [(0, 0), (1, 0)]
    assert list(align.links([1, 3, 6], [3, 4, 6], (2, 3, 1, 3))) == [(2, 1), (2, 2)]
    assert list(align.links([2, 5, 6], [3, 4, 6], (0, 3, 0, 3))) == [(0, 0), (1, 0), (1, 1), (1, 2), (2, 2)]


def test_runs_of_pieces_give_what_pieces_alone_give(tokenizers):
    both = align.Tokenizers(*queries.tokenizer_files())
    pieces = list(dict.fromkeys(p for t in ODD if t and len(t) < 9000 for p in align.LONE_SPACE.split(t)))
    together = both.aligned(pieces)
    alone = [x for p in pieces for x in both._run([p])]
    for name in ("facts", "counts", "pairs"):
        assert np.concatenate([getattr(x, name) for x in together]).tolist() == np.concatenate([getattr(x, name) for x in alone]).tolist()
    assert [g for x in together for g in x.groups] == [g for x in alone for g in x.groups]
