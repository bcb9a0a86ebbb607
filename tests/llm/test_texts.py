"""Corpus operators over texts against libraries, brute force and held-out rows; odd rows in every column."""

import hashlib
import math
import os
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import regex
from pyspark.sql import functions as F

from lendspark.llm import bpe, langid, linededup, minhash, mixing, quality, tokencount
from lendspark.llm import queries as corpus
from lendspark.llm.common import bounded_sample

BPE = P.path("byte_bpe_multi_50k.tiktoken")
PIECES = P.path("piece_bpe_32k.model")
LONG = "lorem ipsum dolor sit amet consectetur " * 3000
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key long, th long, size long, h string, w int, ids string, "
          "score string, language string, digest int, _th int, _key int, _gone int, n_cut string, mark int, n_tokens string")
TEXTS = [(None, None), (1, None), (2, ""), (3, "  \n\t \n"), (4, "one"), (5, "!!! ... 123"), (6, LONG), (7, "x" * 20000), (8, "Hello  world\n\nHello  world \x00 é 日本 😀"),
         (8, "Hello  world\n\nHello  world \x00 é 日本 😀"), (8, "another text under the same id with several words"), (9, "<|endoftext|> don't <s> </s>"),
         (None, "a text without an id but with words enough to be seen")]


def docs(spark, rows=TEXTS):
    """Documents whose further columns clash with names that the operators use."""
    return spark.createDataFrame([(i, t, None if i == 4 else "en", None if k % 3 == 0 else f"s{k % 2}", None, *[None] * 15)
                                  for k, (i, t) in enumerate(rows)], SCHEMA)


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_bpe_equals_library(spark, sf):
    import tiktoken

    own = bpe.codec(BPE, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(3)
    texts = ["".join(rng.choice("abeinrst éß ,.\n\t 12'll日") for _ in range(n)) for n in (1, 2, 17, 70, 300, 4000)]
    texts += ["".join(rng.choice("etaoin") for _ in range(5000)), *(t or "" for _, t in TEXTS)]
    texts += [r.text for r in table(spark, sf, "documents").select("text").collect()]
    packed = own.encode_all(texts)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [library.encode_ordinary(t) for t in texts]
    assert [own.decode(p) for p in packed] == [t.encode() for t in texts]
    pieces = [w.encode() for w in {w for t in texts for w in own.pattern.findall(t)} if len(w) <= 16 and w.encode() not in own.ranks]
    assert own.merge_many(pieces) == [bpe._packed(bpe.merge(p, own.ranks)) for p in pieces]


def test_bpe_odd_rows(spark):
    done = bpe.encode(docs(spark), BPE, P.PATTERN, decoded="back").select("doc_id", "text", "ids", "back").collect()
    assert len(done) == len(TEXTS)
    assert all(bytes(r.back) == (r.text or "").encode() for r in done)
    again = bpe.decode(bpe.encode(docs(spark), BPE, P.PATTERN), BPE, P.PATTERN).select("text", "decoded").collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in again)
    assert bpe.encode(docs(spark).where("false"), BPE, P.PATTERN).count() == 0


def test_token_counts_equal_library(spark, sf):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = tokencount.counter(PIECES)
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdeinth  \t\n.,éß▁ü日😀\x00<s>12") for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += ["".join(rng.choice(list(own.rank)) for _ in range(rng.randint(1, 8))) for _ in range(2000)]
    texts += [r.text for r in table(spark, sf, "documents").select("text").collect()] + [t or "" for _, t in TEXTS]
    assert [own.total(t) for t in texts] == [len(x) for x in library.encode(texts, num_threads=1)]
    for t in texts[:40] + [texts[4100][:300]]:
        counts = own.prefixes(t)
        assert list(counts) == [len(library.encode(t[:i])) for i in range(len(t) + 1)]


def test_token_count_odd_rows(spark):
    rows = {(r.doc_id, r.text): r for r in tokencount.prefix_counts(tokencount.fit_budget(tokencount.count_tokens(docs(spark), PIECES), PIECES, 5), PIECES).collect()}
    assert rows[1, None].n_tokens == 0 and rows[1, None].fitting == "" and rows[1, None].prefix_tokens == [0]
    own = tokencount.counter(PIECES)
    for (_, text), r in rows.items():
        assert r.prefix_tokens[-1] == r.n_tokens
        assert own.total(r.fitting) <= 5 and (text or "").startswith(r.fitting)
    assert tokencount.count_tokens(docs(spark).where("false"), PIECES).count() == 0


def brute_mix(rows, share):
    """Sort by hash, source by source."""
    sizes = Counter()
    for i, t, s in rows:
        sizes[s] += len(regex.findall(r"[^\x20\x09-\x0D]+", t or ""))
    target = mixing.targets(dict(sizes), share, 2.0, mixing.cycle_weight)
    out = []
    for s in sizes:
        own = [(hashlib.md5(f"{'' if i is None else i}|{t or ''}".encode()).hexdigest(), len(regex.findall(r"[^\x20\x09-\x0D]+", t or "")), i) for i, t, z in rows if z == s]
        whole = int(target[s] // sizes[s]) if sizes[s] else 0
        left, below = target[s] - whole * sizes[s], 0
        for h in sorted({h for h, _, _ in own}):
            group = [x for x in own if x[0] == h]
            n = sum(x[1] for x in group)
            more = left > 0 and 2 * below + n <= 2 * left
            below += n
            out += [(x[2], x[1], whole + more) for x in group]
    return Counter(out), sizes, target


@pytest.mark.parametrize("share", [0.0, 0.4, 1.5, 2.0])
def test_mix_equals_sorting(spark, share):
    rng = random.Random(5)
    rows = [(k, "w " * rng.choice([0, 1, 3, 40]), rng.choice(["a", "a", "a", "B", "é", None])) for k in range(300)]
    rows += [(7, "same row", "a")] * 3 + [(None, None, None), (None, "null id", "B"), (1, "big " * 3000, "é")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, h int, size int")
    want, sizes, target = brute_mix(rows, share)
    got = mixing.mix(df, share=share).collect()
    assert Counter((r.doc_id, r["size"], r.copies) for r in got) == want
    assert all(r.source_size == sizes[r.source] and r.target == target[r.source] and r.copies <= 2 for r in got)
    taken = Counter(r.doc_id for r in mixing.mixed(df, share=share).collect())
    assert taken == Counter({i: n for i, n in sum((Counter({i: c * m}) for (i, _, c), m in want.items()), Counter()).items() if n})


def test_mix_nests_and_resharing(spark):
    rows = [(k, "w " * (k % 9), "ab"[k % 2]) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    small, large = ({r.doc_id: r.copies for r in mixing.mix(df, share=s).collect()} for s in (0.5, 0.9))
    assert all(small[i] <= large[i] for i in small)
    assert mixing.targets({"a": 10, "b": 1000, "c": 10}, 1.5, 2.0, mixing.cycle_weight) == {"a": 20.0, "b": 1490.0, "c": 20.0}
    assert mixing.mix(df.where("false")).count() == 0 and mixing.mix(docs(spark)).count() == len(TEXTS)


def brute_bits(pairs, word):
    """Code length of a word from the training words themselves."""
    def follow(context):
        out = Counter()
        for w, n in pairs.items():
            raw = b" " + w.encode() + b" "
            for i in range(1, len(raw)):
                if len(context) <= i and raw[i - len(context):i] == context:
                    out[raw[i]] += n
        return out
    raw, bits = b" " + word.encode() + b" ", 0.0
    for i in range(1, len(raw)):
        for k in range(min(langid.ORDER, i), -1, -1):
            seen = {b: c for b, c in follow(raw[i - k:i]).items() if c > 1 or k < 2}
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if raw[i] in seen:
                bits += np.log2(whole / seen[raw[i]])
                break
            bits += np.log2(whole / len(seen))
        else:
            bits += 8
    return bits


def test_language_code_lengths(spark):
    words = {"de": "der die das der und über die der", "en": "the of the and the then this that"}
    df = spark.createDataFrame([(k, w, lang) for k, (lang, w) in enumerate(words.items())] + [(9, None, "fr"), (10, "mot", None)], "doc_id long, text string, lang string")
    model = langid.train(df)
    assert model.languages == ["de", "en"]
    scorer = langid.Scorer(model)
    for word in ("der", "then", "übung", "qqq"):
        want = [brute_bits(Counter(words[lang].split()), word) for lang in model.languages]
        assert np.allclose(scorer.word_bits(word), want)
    total = scorer.text("Der 12 then... übung")
    assert np.allclose(total[:2], np.sum([scorer.word_bits(w) for w in ("der", "then", "übung")], axis=0))


def test_language_held_out_and_odd_rows(spark, sf):
    df = table(spark, sf, "documents")
    model = langid.train(df.where("pmod(crc32(cast(cast(doc_id as string) as binary)), 4) <> 2"))
    rows = langid.identify(df, model).where("pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2").collect()
    assert np.mean([r.lang == r.language for r in rows]) > 0.95 and not any(r.rejected for r in rows)
    odd = {(r.doc_id, r.text): r for r in langid.identify(docs(spark), model).collect()}
    for i, text in ((1, None), (2, ""), (5, "!!! ... 123")):
        assert odd[i, text].language == "und" and odd[i, text].score == 0 and odd[i, text].rejected
    assert len(odd) == len(set(TEXTS))
    nothing = langid.train(df.where("false"))
    assert {r.language for r in langid.identify(docs(spark), nothing).collect()} == {"und"}


def test_quality_held_out_and_odd_rows(spark):
    sf = "/root/testdata/sf0.01" if os.path.isdir("/root/testdata/sf0.01") else "/root/testdata/sf0.001"
    df, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    seen = labels.where("pmod(crc32(cast(cast(doc_id as string) as binary)), 3) <> 1").selectExpr("doc_id", "quality AS label")
    model = quality.train(df, seen)
    assert (quality.train(df.repartition(7), seen.repartition(3)) == model).all()  # the same weights in every run
    rows = [(r.score, r.quality) for r in quality.score(df, model).join(labels, "doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    good, bad = [s for s, q in rows if q == 1], [s for s, q in rows if q == 0]
    assert np.mean([[g > b for g in good] for b in bad]) > 0.9
    odd = quality.score(docs(spark), model).collect()
    assert len(odd) == len(TEXTS) and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in quality.score(docs(spark), quality.train(df, seen.where("false"))).collect()} == {0.5}


def bag(text):
    w = regex.findall(r"\w+", (text or "").lower())
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def brute_groups(rows, similarity=0.8):
    bags, group = [bag(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and sum((bags[i] & bags[j]).values()) >= similarity * sum((bags[i] | bags[j]).values()):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    return group


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    e = rng.integers(0, 2 ** 63, 400).astype(np.uint64)
    a, b = rng.integers(1, 6, 400), rng.integers(1, 6, 400)
    sig = minhash.signatures([(e, a), (e, b), (e[:1], a[:1])], 2000)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.04
    alone = minhash.signatures([(e, b)], 2000)  # whatever else is in the batch
    assert (alone[0] == sig[1]).all() and np.isfinite(sig).all()


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 30, 120]))]
        for k in range(rng.choice([1, 2, 9])):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 4]) if len(words) > 5 else 0):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows) + 20, (" " if g % 2 else ", ").join(words).title()))
    rows += [(i, t) for i, t in TEXTS if i not in (6, 7)] + [(500, LONG), (501, LONG + " x"), (502, "x" * 20000)]
    rows = list(dict.fromkeys(rows))
    want = brute_groups(rows)
    found = minhash.near_duplicates(docs(spark, rows + [rows[0]])).collect()
    assert len(found) == len(rows) + 1
    lead = {}
    for g, (i, _) in zip(want, rows):
        lead[g] = min([x for x in (lead.get(g), i) if x is not None], default=None)
    expect = Counter((i, lead[g]) for g, (i, _) in zip(want, rows))
    expect[rows[0][0], lead[want[0]]] += 1
    assert Counter((r.doc_id, r.group_id) for r in found) == expect
    assert sum(r.kept for r in found) - sum(r.kept for r in found if r.doc_id == rows[0][0]) // 2 == len(set(want))
    kept = minhash.drop_near_duplicates(docs(spark, rows)).collect()
    assert len(kept) == len(set(want))
    assert minhash.near_duplicates(docs(spark).where("false")).count() == 0


def test_repeated_rows_keep_one(spark):
    text, other = "a text that was taken in again and again", "some further words that nothing else here has"
    rows = [(3, text)] * 4 + [(5, text)] * 2 + [(None, other)] * 5 + [(7, "alone on this line with words"), (None, None), (9, ""), (9, "")]
    kept = minhash.drop_near_duplicates(docs(spark, rows))
    assert kept.columns == docs(spark).columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(3, text), (None, other), (7, "alone on this line with words"), (None, None), (9, ""), (9, "")])
    marked = minhash.near_duplicates(docs(spark, rows)).where("kept and n_shingles > 0").collect()
    assert Counter((r.doc_id, r.group_id) for r in marked) == Counter([(3, 3), (None, None), (7, 7)])


def brute_lines(rows):
    """Every run of at least MIN_WORDS words that occurred before."""
    first, gone = {}, {}
    for doc, text in sorted({r for r in rows}):
        lines = [(k, line.strip(), len(regex.findall(r"[^\x20\x09-\x0D]+", line))) for k, line in enumerate(text.split("\n"))]
        total, lines = len(lines), [x for x in lines if x[2]]
        after = {x[0]: y for x, y in zip(lines, [x[0] for x in lines[1:]] + [total])}  # blank lines go with the line before them
        runs = [(lines[i:j]) for i in range(len(lines)) for j in range(i + 1, len(lines) + 1) if sum(x[2] for x in lines[i:j]) >= linededup.MIN_WORDS]
        for run in runs:
            first.setdefault(tuple(x[1] for x in run), (doc, run[-1][0]))
        for run in runs:
            at = first[tuple(x[1] for x in run)]
            if at[0] != doc or run[0][0] > at[1]:
                gone.setdefault(doc, set()).update(range(run[0][0], after[run[-1][0]]))
    return gone


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(7)
    pool = ["a", "b c", "d e f", "one two three four five", "six seven eight nine ten eleven", "", "  ", "g", "h i j k"]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 14)))) for k in range(60)]
    gone = brute_lines(rows)
    got = {r.doc_id: (r.text, r.n_cut) for r in linededup.dedup_lines(docs(spark, rows)).collect()}
    for doc, text in rows:
        kept = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone.get(doc, ()))
        assert got[doc] == (kept if kept.strip() or not gone.get(doc) else "", len(gone.get(doc, ())))


def test_line_dedup_odd_rows(spark):
    got = linededup.dedup_lines(docs(spark)).collect()
    assert len(got) == len(TEXTS)
    by = {(r.doc_id, r.text) for r in got}
    assert (1, None) in by and (2, "") in by and (3, "  \n\t \n") in by and (6, LONG) in by
    assert linededup.dedup_lines(docs(spark).where("false")).count() == 0
    hot = [(k, "the very same line in all of them\nown line of number %d here" % k) for k in range(300)]
    cut = [r.n_cut for r in linededup.dedup_lines(docs(spark, hot)).orderBy("doc_id").collect()]
    assert cut == [0] + [1] * 299


@pytest.mark.parametrize("name", sorted(corpus.ORACLES))
def test_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = corpus.QUERIES[name](spark, sf)
    cur = con.execute(corpus.ORACLES[name])
    cols = [c[0] for c in cur.description]
    assert sorted(got.columns) == sorted(cols)
    order = sorted(cols)
    assert sorted((tuple(r[c] for c in order) for r in got.collect()), key=str) == sorted(
        (tuple(r[cols.index(c)] for c in order) for r in cur.fetchall()), key=str)


@pytest.mark.parametrize("ids", ["null", "one", "repeated"])
def test_fits_hold_their_bound_whatever_the_ids(spark, sf, ids):
    """All ids null, one id for all, and rows repeated in full: languages are learnt from a bounded sample and no document is lost."""
    docs = table(spark, sf, "documents").where("lang is not null and length(text) > 40").select("doc_id", "lang", "text").limit(150)
    if ids == "null":
        docs = docs.withColumn("doc_id", F.lit(None).cast("long"))
    elif ids == "one":
        docs = docs.withColumn("doc_id", F.lit(7).cast("long"))
    else:
        docs = docs.crossJoin(spark.range(20)).drop("id")
    docs = docs.persist()
    n, texts = docs.count(), docs.select("doc_id", "text", "lang").distinct().count()
    sample = bounded_sample(docs, "lang", ["doc_id", "text"], 12)
    sizes = {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()}
    assert set(sizes) == {r.lang for r in docs.select("lang").distinct().collect()} and max(sizes.values()) <= 18 and min(sizes.values()) > 0
    assert bounded_sample(docs.withColumn("all", F.lit(0)), "all", ["doc_id", "text", "lang"], 1000).count() == texts
    done = langid.identify(docs, langid.train(docs, rows_per_language=12))
    assert done.where("rejected").count() == 0 and done.where("language = lang").count() > 0.9 * n
    labels = spark.createDataFrame([(7, 1)], "doc_id long, label int")
    weights = quality.train(docs, labels, max_rows=30)
    assert weights.any() == (ids == "one" or docs.where("doc_id = 7").count() > 0)


def test_leader_follows_its_rule():
    """The learner against its update rule written out coordinate by coordinate, and sparse scores against dense products."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(rng.randint(0, 30))) for _ in range(40)]
    own = quality.Features()
    examples = [(*own.of(t), rng.randint(0, 1)) for t in texts]
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for at, value, label in examples * quality.EPOCHS:
        w = {int(i): weight(int(i)) for i in at}
        dot = sum(w[int(i)] * float(v) for i, v in zip(at, value))
        p = 1 / (1 + math.exp(-dot))
        for i, v in zip(map(int, at), map(float, value)):
            g = (p - label) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
            n[i] += g * g
    got = quality.fit(examples)
    assert set(np.flatnonzero(got)) <= set(n)
    assert all(abs(got[i] - weight(i)) < 1e-12 for i in n)
    for at, value, _ in examples:
        dense = np.zeros(len(got))
        np.add.at(dense, at, value)
        assert abs(float(value @ got[at]) - float(dense @ got)) < 1e-9
