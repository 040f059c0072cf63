"""Operators that SQL can't express against plain Python over the same rows, round trips and held-out labels."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import links, mixing, near, packing, queries, rules, sharding, shingles, spans, toxicity, urls, warc, winnow
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"
SF3 = "/root/testdata/sf0.1"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in table(spark, SF, "documents").collect()}


# Near duplicates


def test_components_are_the_smallest_reachable_node(spark):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1040)] + [(7, 7)]
    found = {r["node"]: r["label"] for r in links.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    assert found == {x: root(x) for x in parent if any(x in p and p[0] != p[1] for p in pairs)}


def shingle_sets(texts, width):
    out = {}
    for key, text in texts.items():
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(text or "")]
        out[key] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    return out


def brute_components(sets, percent):
    label = {k: k for k in sets}
    keys = sorted(sets)
    changed = True
    linked = []
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    linked.append((a, b))
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_chains_and_crowds_of_near_copies_are_found_whole(spark, monkeypatch):
    """Many edits of one text, most of which are not similar enough to the bucket's ends, in blocks of a few rows."""
    monkeypatch.setattr(near, "BLOCK", 7)
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(80)]
    texts = {}
    for k in range(120):
        words = list(base)
        for at in rng.integers(0, 80, rng.integers(0, 5)):
            words[at] = f"x{rng.integers(0, 30)}"
        texts[k] = " ".join(words)
    for k in range(120, 160):  # short texts that share words
        texts[k] = " ".join(f"s{x}" for x in rng.integers(0, 4, rng.integers(1, 6)))
    texts[160], texts[161], texts[162] = None, "", texts[159].upper()
    df = spark.createDataFrame(sorted(texts.items(), reverse=True), "doc_id bigint, text string")
    for width, percent in ((3, 85), (5, 80)):
        rows = near.near_duplicates(df, width, percent).collect()
        sets = shingle_sets(texts, width)
        assert {r["doc_id"]: r["n_shingles"] for r in rows} == {k: len(v) for k, v in sets.items()}
        assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(sets, percent)
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_registers_estimate_the_similarity():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for share in (0.0, 0.5, 0.85, 1.0):
        both = int(3000 * 2 * share / (1 + share))
        other = np.append(one[:both], rng.integers(0, 2**63, 3000 - both).astype(np.uint64))
        found = shingles.estimates(shingles.registers(one), shingles.registers(other)[None, :])[0]
        assert abs(found - share) < 0.17
    found = shingles.registers(one[:5])
    assert (found != shingles.EMPTY).sum() <= 5
    assert shingles.bands(found[None, :], 4).shape == (1, 32)
    assert shingles.rows_per_band(0.85) == 5 and shingles.rows_per_band(0.8) == 4


# Mixing


def test_mix_meets_its_targets(spark):
    rows = mixing.mix(table(spark, SF2, "documents")).collect()
    texts = {r["doc_id"]: r for r in table(spark, SF2, "documents").collect()}
    sizes, taken, most = Counter(), Counter(), Counter()
    for r in rows:
        assert r["size"] == len(WORD.findall(texts[r["doc_id"]]["text"] or ""))
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, full, total = {}, set(), 1.5 * sum(sizes.values())
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        share = sum(weight[s] for s in sizes if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else left * weight[s] / share for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]], rel=1e-9)
    assert all(abs(taken[s] - target[s]) <= most[s] for s in sizes)
    again = mixing.mix(table(spark, SF2, "documents").repartition(5)).collect()
    assert {(r["doc_id"], r["taken"]) for r in rows} == {(r["doc_id"], r["taken"]) for r in again}
    repeated = mixing.mixed(table(spark, SF2, "documents")).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in repeated} == {r["doc_id"]: r["copies"] for r in rows if r["copies"]}


def test_rounds_of_a_tree_keep_the_words(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 5)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    df = spark.createDataFrame([(k, "w " * (1 + k % 17), "s" if k % 3 else "t") for k in range(400)], "doc_id bigint, text string, source string")
    rows = mixing.mix(df, weights=(2, 3), share=0.7).collect()
    for source in "st":
        own = [r for r in rows if r["source"] == source]
        assert len(own) == (266 if source == "s" else 134)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 17


def test_pivotal_rounding_is_fair():
    sizes, fractions = np.array([3.0, 5.0, 2.0, 7.0, 4.0]), np.array([0.3, 0.6, 0.5, 0.2, 0.9])
    rng = np.random.default_rng(0)
    runs = np.array([mixing.pivotal(sizes, fractions, rng.random(5)) for _ in range(20_000)])
    assert np.abs(runs.mean(axis=0) - fractions).max() < 0.02
    assert np.allclose(runs @ sizes, sizes @ fractions)
    assert (((runs > 0) & (runs < 1)).sum(axis=1) <= 1).all()


def test_repeated_rows_are_dealt_their_copies(spark):
    df = spark.createDataFrame([(1, "a b c", "s", 0)] * 5 + [(2, "d e", "s", 0), (3, "f", None, 0)], "doc_id bigint, text string, source string, size int")
    taken = sum(r["taken"] for r in mixing.mix(df, share=0.8).collect())
    rows = mixing.mixed(df, share=0.8)
    assert rows.columns == df.columns
    assert sum(len(r["text"].split()) for r in rows.collect()) == taken


# Packing


def test_packed_pieces_are_the_documents(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries.op4_packing(spark, SF).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(docs)
    for key, pieces in by_doc.items():
        ids = [*tokenizer.encode(docs[key]["text"] or "", add_special_tokens=False).ids, 0]
        at = 0
        for p in sorted(pieces, key=lambda r: r["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[p["start"] : at], "<u4").tobytes())
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024 and at & (at - 1) == 0


@pytest.mark.parametrize(
    "text", ["", " ", "a", " a", "a ", "a  b", "a \n b", "\n\na b\n", "it's a  'x' 9,000.5 x y 　z", "a\x1cb \x85 c", "é 漢字  \U0001f600 !!", "a b " * 40, "tab\t x"]
)
def test_ids_of_cut_texts_are_those_of_the_whole(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.Ids(*queries.tokenizer()).of(text), "<u4").tolist() == whole


@pytest.mark.parametrize(
    "text", ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b", "a  <|endoftext|>  b\n", "<|endoftext|><|endoftext|> <|endoftext|>", "x <|endoftext| y <|endoftext|>", "é 漢<|endoftext|> 9"]
)
def test_names_of_added_tokens_have_their_own_id(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    assert 50256 in whole
    assert np.frombuffer(packing.Ids(*queries.tokenizer()).of(text), "<u4").tolist() == whole


def test_sum_of_squares_places_a_piece_at_the_best_level():
    rng = np.random.default_rng(2)
    levels, fills = packing.Levels(16), Counter()
    for k in range(300):
        size = int(rng.integers(1, 16))
        costs = {}
        for level in [0, *(f for f, n in fills.items() if n and f + size <= 16)]:
            after = fills.copy()
            if level:
                after[level] -= 1
            if level + size < 16:
                after[level + size] += 1
            costs[level] = sum(n * n for n in after.values())
        best = max(x for x, c in costs.items() if c == min(costs.values()))
        window = levels.place(size)
        assert sum(p[1] for p in window) == best
        window.append((k, size))
        fills[best] -= bool(best)
        if best + size < 16:
            fills[best + size] += 1
            levels.put(window, best + size)
        assert levels.counts.tolist() == [fills[f] for f in range(16)]


def test_windows_lose_no_id():
    rng = np.random.default_rng(4)
    texts = [(k, rng.integers(0, 99, int(rng.integers(0, 70))).astype("<u4").tobytes()) for k in range(200)]
    for most in (3, 1000):
        back = defaultdict(dict)
        for window in packing.packed_windows(iter(texts), 32, most):
            fill = sum(len(p[2]) // 4 for p in window)
            assert fill <= 32 and fill & (fill - 1) == 0
            for doc, start, raw, _ in window:
                back[doc][start] = raw
        assert all(b"".join(v for _, v in sorted(back[k].items())) == raw for k, raw in texts)


# Archives


def test_frames_can_be_read_alone(tmp_path):
    import pyarrow.fs as pafs

    files, path = pafs.FileSystem.from_uri(f"file://{tmp_path}/x.warc.zst")
    bundle = warc.Bundle(files.open_output_stream(path, compression=None))
    records = [warc.record(k, f"http://a/{k}", b"x%d" % k * 90_000, None, False) for k in range(40)]
    places = [bundle.add(r) for r in records]
    bundle.close()
    source = files.open_input_file(path)
    entries = warc.seek_table(source)
    assert len(entries) > 3
    for raw, place in zip(records[::7], places[::7], strict=True):
        frame = warc.frame_of(source, entries[place.frame])
        assert frame[place.offset : place.offset + place.size] == raw
        headers, block, end = warc.parsed(frame, place.offset)
        assert headers["WARC-Type"] == "response" and end == place.offset + place.size


# Fingerprints


def plain_winnow(text, k, window):
    grams = [winnow.kgram_hashes(text[i : i + k], k)[0] for i in range(max(1, len(text) - k + 1))] if text else []
    kept = []
    for i in range(max(1, len(grams) - window + 1) if grams else 0):
        part = grams[i : i + window]
        at = max(j for j, g in enumerate(part) if g == min(part)) + i
        if not kept or kept[-1] != at:
            kept.append(at)
    return kept


def test_kept_positions_are_the_rightmost_minima(docs):
    texts = [r["text"][:400] for r in list(docs.values())[:6]] + ["", "a", "ab" * 40, "x" * 100, "é\U0001f600" * 9]
    for text in texts:
        for k, window in ((16, 16), (3, 5), (4, 1), (7, 12)):
            assert winnow.fingerprint(text, k, window)[1].tolist() == plain_winnow(text, k, window)


def test_edited_texts_follow_the_descending_ids(spark, docs):
    rows = {r["doc_id"]: r for r in queries.op9_winnowing(spark, SF).collect()}
    order = sorted(docs, reverse=True)
    assert set(rows) == set(docs)
    for k, key in enumerate(order):
        text, after = docs[key]["text"] or "", docs[order[(k + 1) % len(order)]]["text"] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        r, own, other, nxt = rows[key], winnow.fingerprint(text), winnow.fingerprint(changed), winnow.fingerprint(after)
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (winnow.digest(own), winnow.digest(other))
        for name, x in (("near_edited", other), ("near_next", nxt)):
            a, b = set(own[0].tolist()), set(x[0].tolist())
            assert r[name] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)


def test_a_single_document_follows_itself(spark):
    (row,) = winnow.compare_edited(spark.createDataFrame([(4, "abcd")], "doc_id bigint, text string")).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1.0


# Spans


def plain_runs(pieces):
    words = [(k, p.lower().split()) for k, p in enumerate(pieces) if p.split()]
    found = set()
    for i in range(len(words)):
        for step in (1, -1):
            j, n, count = i, 0, 0
            while 0 <= j < len(words):
                n, count = n + len(words[j][1]), count + 1
                if n >= spans.SPAN_WORDS and count >= spans.SPAN_SENTENCES:
                    a, b = min(i, j), max(i, j)
                    found.add((words[a][0], words[b][0], tuple(" ".join(w) for _, w in words[a : b + 1])))
                    break
                j += step
    return found


def test_sentences_of_later_spans_go(spark):
    rng = np.random.default_rng(9)
    vocabulary = [f"w{k}" for k in range(500)]

    def sentence():
        return " ".join(rng.choice(vocabulary, rng.integers(1, 30))) + str(rng.choice([".", "!", "?"]))

    passage = " ".join(sentence() for _ in range(9))
    texts = {}
    for k in range(40):
        parts = [" ".join(sentence() for _ in range(rng.integers(0, 8))) for _ in range(2)]
        shared = passage if k % 3 == 0 else "\n".join(passage.split(". ")[k % 4 :]) if k % 3 == 1 else ""
        texts[k] = f"{parts[0]}\n{shared} {parts[1]}"
    texts[40], texts[41], texts[42] = None, "", passage + "\n" + passage
    df = spark.createDataFrame(sorted(texts.items(), reverse=True), "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in spans.remove_repeats(df).collect()}
    seen = {}
    for key in sorted(texts):
        pieces = spans.sentences(texts[key])
        assert "".join(pieces) == (texts[key] or "")
        gone = set()
        for a, b, run in sorted(plain_runs(pieces)):
            if seen.setdefault(run, (key, a)) != (key, a):
                gone |= set(range(a, b + 1))
        kept = "".join(p for k, p in enumerate(pieces) if k not in gone)
        assert (rows[key]["text"] or "") == kept and rows[key]["n_removed"] == len(gone)
    assert rows[40]["text"] is None and rows[41]["text"] == ""
    assert passage in rows[0]["text"] and all(passage not in (rows[k]["text"] or "") for k in range(1, 43))


@pytest.mark.parametrize(("n", "sentence"), [(51, 0), (60, 0), (100, 0), (200, 0), (60, 30), (60, 20), (51, 17)])
def test_passages_are_caught_at_any_offset(n, sentence):
    """Without marks, or in sentences that the texts' own words open and end, each time at other places."""
    rng = np.random.default_rng(n + sentence)
    for k in range(100):
        passage = [f"p{x}" + "." * bool(sentence and x % sentence == sentence - 1) for x in range(n * k, n * k + n)]
        one, two = ([f"{name}{x}" + "." * bool(rng.random() < rng.choice([0, 0.1])) for x in range(rng.integers(0, 120))] for name in "ab")
        at, to = rng.integers(0, len(one) + 1), rng.integers(0, len(two) + 1)
        gone = np.unique(spans.runs(spans.cut(" ".join(one[:at] + passage + one[at:])))[0])
        kept = spans.cleaned(" ".join(two[:to] + passage + two[to:]), gone)[0].split()
        assert [w for w in kept if w[0] == "b"] == two
        assert sum(w[0] == "p" for w in kept) <= 2 * spans.WINDOW


# Toxicity, rules, urls and shards


def test_toxic_documents_are_found_among_the_held_out(spark):
    rows = {r["doc_id"]: r for r in queries.op7_toxicity(spark, SF2).collect()}
    labels = table(spark, SF2, "labels").collect()
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows.values())
    out = [(rows[x["doc_id"]]["predicted"], x["toxic"]) for x in labels if rows[x["doc_id"]]["held_out"]]
    hits, found, there = sum(p and t for p, t in out), sum(p for p, _ in out), sum(t for _, t in out)
    assert there >= 5 and hits >= 0.6 * there and hits >= 0.8 * found


def test_scores_of_a_capped_sample_are_near_those_of_all_labels(spark, monkeypatch):
    docs, labels = table(spark, SF3, "documents"), table(spark, SF3, "labels")

    def figures():
        found = toxicity.score(docs, toxicity.fit(docs, labels)).select("score").toPandas()["score"]
        return found.mean(), (found >= queries.TOXIC_FROM).sum()

    mean, predicted = figures()
    for rows in (400, 200):  # of about 2670 clean and 330 toxic
        monkeypatch.setattr(toxicity, "TRAIN_ROWS", rows)
        capped_mean, capped_predicted = figures()
        assert abs(capped_mean - mean) < 0.02 and abs(capped_predicted - predicted) < 0.2 * predicted


def test_segments_are_all_maximal():
    rng = np.random.default_rng(8)
    for _ in range(200):
        scores = np.round(rng.normal(-0.3, 2, rng.integers(1, 14)), 3)
        found = toxicity.segments(scores)
        # The definition: the best segment, then the same to its left and to its right.
        def split(a, b):
            best = max(((scores[i:j].sum(), -i, -j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
            if best[0] <= 1e-9:
                return []
            i, j = -best[1], -best[2]
            return [*split(a, i), (i, j - 1), *split(j, b)]

        got = [(a, b) for s, a, b in found]
        assert sum(s for s, _, _ in found) == pytest.approx(sum(scores[a : b + 1].sum() for a, b in split(0, len(scores))))
        assert len(got) == len(split(0, len(scores)))


def test_policies_and_ablations_use_the_ledger(spark):
    entries = rules.ledger(table(spark, SF2, "documents"))
    bits = [r["failed"] for r in entries.select("failed").collect()]
    names = [r.name for r in rules.RULES]
    for r in rules.ablations(entries, (rules.BASE, rules.STANDARD)).collect():
        policy = {p.name: p for p in (rules.BASE, rules.STANDARD)}[r["policy"]]
        mask, bit = policy.mask(), 1 << names.index(r["rule"])
        assert r["failing"] == sum(bool(b & bit) for b in bits)
        assert r["only"] == sum((b & mask) == bit for b in bits)
        assert r["kept_without"] == sum(not b & mask & ~bit for b in bits)
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF2, "labels").collect()}
    kept = {r["doc_id"]: r["ok"] for r in entries.select("doc_id", rules.passes(rules.STANDARD).alias("ok")).collect()}
    good = [kept[k] for k, q in labels.items() if q == 1]
    bad = [kept[k] for k, q in labels.items() if q == 0]
    assert np.mean(good) > 0.9 and np.mean(bad) < 0.1


def test_learnt_urls_follow_the_labelled_ones(spark):
    rows = [(k, f"http://a{k}.org/article/{k}.html") for k in range(200)] + [(k, f"http://b{k}.com/de/zzq{k}") for k in range(200, 400)]
    rows += [(k, f"http://x{k}.net/article/{k}.html") for k in range(400, 440)] + [(k, f"http://x{k}.net/de/zzq{k}") for k in range(440, 480)]
    judged = urls.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string"), queries.URL_RULES)
    learnt = {r["page_id"]: r["verdict"] for r in judged.where("rule is null").collect()}
    assert len(learnt) == 80
    assert sum(learnt[k] == "allow" for k in range(400, 440)) >= 36 and sum(learnt[k] == "block" for k in range(440, 480)) >= 36


def test_slots_are_shared_evenly_and_stay_when_a_shard_goes():
    names = [f"s{k}" for k in range(20)]
    before = sharding.lookup_table(names, 2003)
    assert max(Counter(before).values()) - min(Counter(before).values()) <= 1
    after = sharding.lookup_table(names[:-1], 2003)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 19)
    assert moved < 0.2 * 2003
    for wrong in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(wrong, 2003)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 2001)
