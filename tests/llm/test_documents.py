"""The operators on documents against brute force, over real rows and every awkward one."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfline.llm import jaccard, langid, linededup, lmscore, mixing, packing, sharding, substring
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 700}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
ODD = [
    (1000, None, None, None), (1001, "", "en", "src0"), (1002, " \t\n ", "en", None), (1003, "one", "en", "src1"), (1004, "ONE", "en", "src1"),
    (1005, LONG, "en", "src1"), (1006, LONG, "en", "src1"), (1007, f"before {PASSAGE} after", "en", "src2"), (1008, PASSAGE, None, "src2"),
    (1009, "12 34 !!", "en", "src3"), (1010, "x  y <|endoftext|> z ", "en", "src3"), (1011, "привет мир", "en", "src3"), (1011, "привет мир", "en", "src3"),
    (None, "a text without an id", "en", "src3"), (1012, "\n".join([PASSAGE, "x", PASSAGE]), "en", "src3"),
]


@pytest.fixture(scope="module")
def docs(spark):
    odd = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    both = spark.read.parquet(f"{SF_SMALL}/documents.parquet").unionByName(odd)
    # extra columns whose names an operator might use itself
    return both.withColumn("size", F.lit("x")).withColumn("a", F.lit(1)).withColumn("_k", F.lit(2)).repartition(5).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]


def words(text):
    return WORD.findall(text or "")


def components(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def test_sharding(docs, rows):
    out = sharding.shard_by_bytes(docs, shards=7).collect()
    size = {i: len((t or "").encode()) + 16 for i, t, _ in rows}
    assert Counter(r["doc_id"] for r in out) == Counter(i for i, _, _ in rows)
    assert all(r["size"] == size[r["doc_id"]] for r in out)
    crc = {i: None if t is None else zlib.crc32(t.encode()) for i, t, _ in rows}
    assert all(r["text_crc32"] == crc[r["doc_id"]] for r in out)
    total, by = sum(r["size"] for r in out), {}
    for r in sorted(out, key=lambda r: (r["shard"], r["slot"])):
        by.setdefault(r["shard"], []).append(r)
    for shard in by.values():
        assert [r["slot"] for r in shard] == list(range(len(shard)))
        assert abs(sum(r["size"] for r in shard) - total / 7) <= max(size.values())
    ids = [r["doc_id"] or -1 for shard in sorted(by) for r in by[shard]]
    assert ids == sorted(ids)


def test_mixing(docs, rows):
    plan = mixing.plan(docs).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    goal, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while True:  # hand the excess on by weight
        level = goal / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 2 * sizes[s]
            goal -= target[s]
        open_ -= over
    target |= {s: level * weight[s] for s in open_}
    for r in plan:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["copies"] in (int(r["rate"]), int(r["rate"]) + 1)
    again = {(r["doc_id"], r["copies"]) for r in mixing.plan(docs).collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in plan}
    assert Counter(r["doc_id"] for r in mixing.mix(docs).collect()) == Counter(r["doc_id"] for r in plan for _ in range(r["copies"]))


def test_packing(docs, rows):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(path("byte_bpe_50k.json"))
    out = packing.pack(packing.pieces(docs, capacity=256, with_ids=True), capacity=256).collect()
    texts, found, places = {i: t for i, t, _ in rows}, {}, {}
    for r in out:
        found.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in r["ids"])) == r["ids_crc32"]
    for i, own in found.items():
        own.sort(key=lambda r: r["piece"])
        want = reference.encode(texts[i] or "", add_special_tokens=False).ids + [0]
        if i != 1011:  # two rows of this id
            assert [x for r in own for x in r["ids"]] == want
            assert all(r["length"] == 256 for r in own[1:])
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    assert len(places) <= 1.02 * sum(r["length"] for r in out) / 256 + 1


def test_packing_costs_new_words_no_more_than_the_library_takes_for_their_text():
    """Most of a corpus's different words occur once: none is to be encoded in a call of its own."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    encode, draw, whole, reference = packing.encoder("byte_bpe_50k"), random.Random(3), [], Tokenizer.from_file(path("byte_bpe_50k.json"))

    def seconds(text):
        start = time.process_time()
        ids = encode(text)
        return time.process_time() - start, ids

    for _ in range(3):
        text = "".join(" " + "".join(draw.choices("abcdefgh", k=9)) for _ in range(60_000))
        glued, (spent, ids) = seconds(text.replace(" ", "\n"))[0], seconds(text)  # without a space there is nothing to cut at
        whole.append(spent / glued)
    assert ids == b"".join(x.to_bytes(4, "little") for x in reference.encode(text, add_special_tokens=False).ids)
    assert min(whole) < 1.5


def test_substring_dedup(docs, rows):
    # a small shard makes hot anchors split into blocks
    for spans in (substring.SHARD_SPANS, 2):
        out = {r["doc_id"]: r for r in substring.remove_repeats(docs, shard_spans=spans).collect()}
        seen: dict[tuple, tuple] = {}
        ordered = sorted({(i is None, i or 0, t or "") for i, t, _ in rows})
        texts = {}
        for missing, i, t in ordered:
            w = words(t)
            texts[None if missing else i] = w
            for k in range(len(w) - 19):
                seen.setdefault(tuple(w[k:k + 20]), (missing, i, k))
        for i, w in texts.items():
            keep = [True] * len(w)
            for k in range(len(w) - 19):
                if seen[tuple(w[k:k + 20])] < (i is None, i or 0, k):
                    keep[k:k + 20] = [False] * 20
            kept = " ".join(x for x, y in zip(w, keep) if y)
            assert (out[i]["n_words"], out[i]["n_removed"], out[i]["kept_text"]) == (len(w), keep.count(False), kept), i
            assert out[i]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert out[1008]["n_removed"] == 60 and out[1006]["n_removed"] == 30_000


@pytest.mark.parametrize("shard_spans", [substring.SHARD_SPANS, 4])
def test_substring_dedup_of_repeated_and_null_ids(spark, shard_spans):
    """Texts that share an id, or have none, are documents of their own: which copy stays is free, that one stays is not."""
    rnd = random.Random(8)
    vocabulary = [f"w{k}" for k in range(40)]
    texts = []
    for k in range(4000):
        own = [f"{k}x{j}" for j in range(rnd.randrange(30))] if k % 2 or k % 40 == 0 else [rnd.choice(vocabulary) for _ in range(rnd.randrange(30))]
        texts.append(" ".join(own + (PASSAGE.split() if k % 40 == 0 else [])))
    docs = spark.createDataFrame([(None if k < 2000 else 7, f"n{k} {t}") for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    out = substring.remove_repeats(docs, shard_spans=shard_spans).collect()
    assert sorted(len(words(t)) + 1 for t in texts) == sorted(r["n_words"] for r in out)
    assert all(r["n_removed"] in (0, 60) for r in out)
    by = Counter((r["doc_id"], r["n_removed"]) for r in out)
    assert by[7, 60] == 49 and by[None, 60] == 50  # the first copy is one of id 7
    assert sum("shared0" in words(r["kept_text"]) for r in out) == 1


def test_substring_dedup_of_a_hot_anchor_stays_small(spark, monkeypatch):
    judge, most = substring._stream, 40

    def guarded(window):
        run = judge(window)

        def checked(rows):
            if len(rows) > most:
                raise ValueError(f"{len(rows)} spans in one group")
            return run(rows)

        return checked

    monkeypatch.setattr(substring, "_stream", guarded)
    shared = " ".join(f"s{k}" for k in range(24))
    before, after = ([" ".join(f"{c}{d % m}x{k}" for k in range(15)) for d in range(150)] for c, m in (("b", 150), ("e", 50)))
    texts = [f"{x} {shared} {y}" for x, y in zip(before, after, strict=True)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = {r["doc_id"]: r["n_removed"] for r in substring.remove_repeats(docs, shard_spans=8).collect()}
    assert out == {d: 0 if d == 0 else 24 if d < 50 else 39 for d in range(150)}


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_jaccard(docs, rows, n, percent):
    out = jaccard.similar_components(docs, n, percent).collect()
    lower = {c: c + 32 for c in range(65, 91)}
    sets = {}
    for i, t, _ in rows:
        w = words((t or "").translate(lower))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}
    ids = sorted(i for i in sets if i is not None)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    group = components(ids, links)
    assert (1003, 1004) in links and (1005, 1006) in links
    for r in out:
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["component_id"] == (None if r["doc_id"] is None else group[r["doc_id"]])


@pytest.mark.parametrize("turned", [False, True])
def test_jaccard_of_repeated_ids(spark, turned):
    """Different texts of one id each find their links, in either order of the rows; equal rows count once."""
    rnd = random.Random(3)
    passage = [f"p{k}" for k in range(60)]
    text = lambda: [f"x{rnd.randrange(10**9)}" for _ in range(400)]
    base = {i: text() + passage for i in range(40)}
    texts = [(i, w) for i, w in base.items()]
    for i in range(0, 30, 3):  # a near copy under another id, whose own text differs
        near = list(base[i])
        for at in rnd.sample(range(len(near)), 4):
            near[at] = "changed"
        texts.append((i + 1, near))
    texts += [(7, base[7])] * 200 + [(50, base[39])] + [(51, text()) for _ in range(100)]
    rows = [(i, " ".join(w)) for i, w in texts]
    out = jaccard.similar_components(spark.createDataFrame(rows[::-1] if turned else rows, "doc_id long, text string").repartition(3)).collect()
    whole = sorted({(i, tuple(w)) for i, w in texts})
    sets = [(i, {w[k:k + 4] for k in range(len(w) - 3)}) for i, w in whole]
    links = [(a, b) for n, (a, x) in enumerate(sets) for b, y in sets[:n] if a == b or 100 * len(x & y) >= 85 * len(x | y)]
    group = components({i for i, _ in rows}, links)
    assert len({group[i] for i in range(40)}) == 30 and group[50] == 39
    assert Counter((r["doc_id"], r["component_id"]) for r in out) == Counter((i, group[i]) for i, _ in rows)


@pytest.mark.parametrize("work", [1, 100_000])
def test_jaccard_compares_open_buckets_in_tasks_of_any_size(spark, monkeypatch, work):
    """Members that share a bucket meet, however its buckets are dealt and cut into blocks."""
    monkeypatch.setattr(jaccard, "TASK_WORK", work)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rnd = random.Random(4)
    common = [f"c{k}" for k in range(300)]
    rows = [(i, " ".join(common[:150 + rnd.randrange(150)] + [f"u{i % 9}_{rnd.randrange(3)}" for _ in range(rnd.randrange(60))])) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {tuple(w[k:k + 4]) for k in range(len(w) - 3)} for i, w in ((i, t.split()) for i, t in rows)}
    like = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    nodes = jaccard.described(docs, 4).withColumnRenamed("doc_id", "node").drop("text_hash", "set1", "set2").withColumn("component", F.col("node"))
    members = nodes.withColumn("bucket", F.explode(F.array(F.lit(1).cast("long"), F.col("node") % 3 + 2)))
    elements = jaccard._elements(docs.withColumnRenamed("doc_id", "node"), 4)
    found = {(r["a"], r["b"]) for r in jaccard._apart(members, elements, 85).collect()}
    assert like and set(like) <= found


def test_jaccard_buckets_hold_every_link():
    for percent in (80, 85):
        for n in range(1, 400):
            for m in range(-(-n * percent // 100), n + 1):
                if jaccard.differing(percent, n + m) > 0:
                    shared = {k: d for k, d in jaccard.indexes(n, percent) if (k, d) in jaccard.indexes(m, percent)}
                    assert shared and max(shared.values()) >= jaccard.differing(percent, n + m)


def test_language_id(docs):
    model = langid.learn(docs)
    out = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert {out[i]["lang_pred"] for i in (1000, 1001, 1002, 1009)} == {"und"}
    truth = {r["doc_id"]: r["lang"] for r in docs.filter("doc_id < 1000").filter(langid.held_out()).collect()}
    assert sum(out[i]["lang_pred"] == lang for i, lang in truth.items()) >= 0.95 * len(truth)
    for r in out.values():
        assert 0 <= r["score"] <= 1 and (r["lang_pred"] == "und" or sum(s["n_words"] for s in r["spans"]) == r["n_words"])
    assert all(langid.crc_of(i) == 2 for i in truth)


def test_every_language_is_learned(spark):
    """Seventy languages, one of them only in copies of one text, and no label at all."""
    rnd = random.Random(6)
    syllables = [[a + b for a in rnd.sample("bcdfghjklmnpqrstvwxz", 6) for b in rnd.sample("aeiou", 3)] for _ in range(70)]
    text = lambda k: " ".join("".join(rnd.choice(syllables[k]) for _ in range(rnd.randrange(2, 4))) for _ in range(60))
    rows = [(k * 20 + j, text(k), f"l{k:02}") for k in range(70) for j in range(20)] + [(5000 + j, "zzyx qqux " * 30, "copies") for j in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.learn(docs)
    assert len(model.langs) == 71
    out = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, model, spans=False).collect()}
    assert sum(out[i] == lang for i, _, lang in rows[:1400]) >= 1380 and {out[i] for i, _, lang in rows[1400:]} == {"copies"}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    nothing = langid.learn(unlabelled)
    assert nothing.langs == [] and langid.keep_known(unlabelled, nothing).count() == len(rows)
    assert {r["lang_pred"] for r in langid.identify(unlabelled, nothing).collect()} == {"und"}


def best_path(scores, penalty):
    """Every labelling of a few words."""
    import itertools

    value = lambda path: sum(scores[t][k] for t, k in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))
    return max(value(path) for path in itertools.product(range(len(scores[0])), repeat=len(scores))), value


@pytest.mark.parametrize("langs", [3, 300])
def test_viterbi_finds_a_best_path(langs):
    import numpy as np

    rng = np.random.default_rng(4)
    lengths = [5, 0, 1, 6, 3] if langs == 3 else [2, 1]
    scores = rng.normal(size=(sum(lengths), langs))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    labels = langid.viterbi(scores, bounds, 1.3)
    for lo, hi in zip(bounds, bounds[1:]):
        if hi > lo:
            most, value = best_path(scores[lo:hi].tolist(), 1.3)
            assert value(labels[lo:hi].tolist()) == pytest.approx(most)


def test_mixed_language_spans(spark, docs):
    model = langid.learn(docs)
    text = "the and of that with this are for was the of and " * 3 + "der und die nicht von den ist dem mit sich der und " * 3
    row = langid.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [s["lang"] for s in row["spans"]] == ["en", "de"] and abs(row["spans"][0]["n_words"] - 36) <= 2


def lines_to_go(lines):
    """Lines of each document in runs of any length that start earlier too."""
    gone = {k: set() for k in lines}
    for n in range(1, max(map(len, lines.values())) + 1):
        seen = set()
        for key in sorted(lines):
            own = lines[key]
            for k in range(len(own) - n + 1):
                run = tuple(own[k:k + n])
                if run in seen and sum(len(words(x)) for x in run) >= linededup.MIN_WORDS:
                    gone[key].update(range(k, k + n))
                seen.add(run)
    return gone


def test_line_dedup_tries_every_length(spark):
    size = {c: n for c, n in zip("abcdefghij", (8, 8, 8, 25, 15, 4, 0, 1, 19, 3), strict=True)}
    line = {c: " ".join(f"{c}{k}" for k in range(n)) for c, n in size.items()}
    rng = random.Random(7)
    orders = ["abcx", "yabcz", "defx", "zdef", "gghgigg", "xgghgiggz"]
    orders += ["".join(rng.choices("abcefghijabcefghijxyz", k=rng.randrange(4, 30))) for _ in range(40)]
    texts = ["\n".join(line.get(c, f"{c}{k}") for c in order) for k, order in enumerate(orders)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = {r["doc_id"]: r for r in linededup.remove_repeats(docs).collect()}
    gone = lines_to_go({k: x.split("\n") for k, x in enumerate(texts)})
    assert gone[1] == {1, 2, 3} and gone[3] == {1, 2, 3}
    for d, cut in gone.items():
        assert out[d]["removed"] == sorted(cut), orders[d]


def test_line_dedup_of_real_rows_at_every_length(docs, rows):
    out = {r["doc_id"]: r for r in linededup.remove_repeats(docs).collect()}
    lines = {(i is None, i or 0): t.split("\n") for i, t, _ in rows if t is not None}
    for (missing, i), cut in lines_to_go(lines).items():
        r, own = out[None if missing else i], lines[missing, i]
        assert r["removed"] == sorted(cut) and r["n_lines"] == len(own), i
        assert r["text"] == "\n".join(x for k, x in enumerate(own) if k not in cut)
    assert out[1000]["text"] is None and out[1000]["n_lines"] == 0


def test_line_dedup_of_very_many_lines(spark):
    """Mostly blank lines: the runs overlap by thousands."""
    blank = "\n".join(["x" if k % 50 == 0 else "" for k in range(100_000)])
    out = linededup.remove_repeats(spark.createDataFrame([(1, blank), (2, "a\n" + blank)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert out[0]["n_lines"] == 100_000 and out[1]["n_lines"] == 100_001
    assert out[1]["removed"] == list(range(1, 100_001)) and out[1]["text"] == "a"


def test_lm_scoring(docs):
    model = lmscore.learn(docs.filter("coalesce(doc_id, 0) % 5 <> 0"), rounds=2)
    out = {r["doc_id"]: r for r in lmscore.score(docs, model).collect()}
    assert out[1000]["n_tokens"] == 0 and out[1000]["log_likelihood"] == 0 and out[1000]["mean_log_likelihood"] is None
    held = [out[i] for i in range(0, 200, 5)]
    mean = sum(r["log_likelihood"] for r in held) / sum(r["n_tokens"] for r in held)
    flat = lmscore.Model(model.classes, lmscore.Network.from_flat(0 * model.network.flat()), model.cells)
    plain = {r["doc_id"]: r for r in lmscore.score(docs, flat).collect()}
    assert mean > sum(plain[i]["log_likelihood"] for i in range(0, 200, 5)) / sum(r["n_tokens"] for r in held) + 0.2


def test_lm_scoring_counts_every_word(spark):
    # 20,000 words of one ending: a rare one must not score like the frequent one of its hash cell
    rare = [f"r{k}en" for k in range(20_000)]
    texts = ["often " * 2000 + "seen " * 2000] * 5 + [" ".join(rare[k:k + 100]) for k in range(0, 20_000, 100)] + rare[:300] + ["often", "seen"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    model = lmscore.learn(docs)
    flat = lmscore.Model(model.classes, lmscore.Network.from_flat(0 * model.network.flat()), model.cells)
    out = {r["doc_id"]: r["log_likelihood"] for r in lmscore.score(docs, flat).collect()}
    assert sum(1 for _ in lmscore.word_counts(docs).collect()) == 20_002
    by_ending = [out[k] for k in range(205, 505)]
    usual = Counter(round(x, 6) for x in by_ending).most_common(1)[0][1]
    assert usual > 280  # words of count 2 in the class of their ending


def test_empty_tables(docs):
    none = docs.limit(0)
    for out in (
        sharding.shard_by_bytes(none), mixing.plan(none), mixing.mix(none), packing.pack(packing.pieces(none)), substring.remove_repeats(none),
        jaccard.similar_components(none), langid.identify(none, langid.learn(none)), linededup.remove_repeats(none), lmscore.score(none, lmscore.learn(none)),
    ):
        assert out.count() == 0
