"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns for every operator."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyvault.llm import (
    chaining,
    context_tree,
    decontamination,
    extraction,
    language,
    minhash,
    ngram_join,
    packing,
    quality,
    resampling,
    suffix_dedup,
    toxicity,
)
from tallyvault.llm.blocks import blocks, supposed_main
from tallyvault.llm.queries import tokenizer_path
from tallyvault.llm.text import Words, pieces, shingles
from tests.llm import brute

SENTENCE = "the quick brown fox jumps over the lazy dog and runs far away from here "
LONG = "".join(f"word{i % 977} other{i % 991} " for i in range(30_000))
ROWS = [
    (None, SENTENCE * 3, "en"),
    (None, None, None),
    (1, None, "en"),
    (2, "", "en"),
    (3, " \t\n ", None),
    (4, SENTENCE * 6, "en"),
    (5, SENTENCE * 6, "en"),
    (5, SENTENCE * 6, "en"),
    (6, SENTENCE.upper() * 6, "en"),
    (7, LONG, "en"),
    (8, "Ünï cödé été 日本語 текст x " * 5, "xx"),
    (9, "12 34 !!", "en"),
    (10, "a", "en"),
]
CLASHING = ["score", "count", "seed", "doc", "rep", "part", "n", "first", "held_out", "extra", "word", "kept"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    return rows.withColumns({c: F.lit(None).cast("string") for c in CLASHING})


@pytest.fixture(scope="module")
def operators(spark):
    labels = spark.createDataFrame([(4, 1), (6, 1), (7, 0), (8, 0), (None, 1), (10, None)], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, SENTENCE * 2), (2, None), (None, "x"), (3, "")], "item_id long, text string")
    none = F.lit(False)
    return {
        "language": lambda d: language.identify(d, none),
        "quality": lambda d: quality.apply_policy(quality.ledger(d)),
        "chaining": chaining.without_passages,
        "packing": lambda d: packing.pack(d, tokenizer_path()).where("piece = 0"),
        "suffix": suffix_dedup.without_repeats,
        "toxicity": lambda d: toxicity.score_toxicity(d, labels, none),
        "join": ngram_join.similar_classes,
        "decontamination": lambda d: decontamination.find_contamination(d, items),
        "minhash": minhash.near_duplicates,
        "resampling": lambda d: resampling.resample(d, items),
        "tree": lambda d: context_tree.score_texts(d, F.col("doc_id") == 8),
    }


NAMES = "language quality chaining packing suffix toxicity join decontamination minhash resampling tree".split()


@pytest.mark.parametrize("name", NAMES)
def test_every_row_gets_a_result(operators, docs, name):
    found = operators[name](docs).toPandas()
    assert len(found) == len(ROWS)
    assert found.doc_id.isna().sum() == 2


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(operators, docs, name):
    assert operators[name](docs.where("false")).count() == 0


def test_join_of_copies(docs):
    found = {r["doc_id"]: tuple(r)[1:] for r in ngram_join.similar_classes(docs).collect()}
    assert found[4] == found[5] == found[6] and found[4][1] == 4  # case doesn't count
    assert found[1] == (0, 1) and found[2] == (0, 2) and found[3] == (0, 3)
    assert found[10] == (1, 10)


def test_join_of_many_near_copies(spark):
    """Chains of neighbours, copies and near misses, in groups larger than a part of the matrix."""
    random = np.random.default_rng(5)
    rows, base = [], [f"w{i}" for i in range(120)]
    for i in range(400):
        text = list(base) if i % 3 else [f"v{i}_{j}" for j in range(30)]
        for j in random.integers(0, len(text), int(random.integers(0, 9))):
            text[j] = f"x{int(random.integers(0, 60))}"
        rows.append((i, " ".join(text)))
    found = ngram_join.similar_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == brute.similar_classes(rows)


def test_suffix_dedup_of_periodic_texts(spark, docs):
    rows = [
        (1, "ab" * 200), (2, "b" + "ab" * 90), (3, "a" * 99), (4, "a" * 100), (5, "a" * 350), (6, LONG[:4000]),
        (7, "x" + LONG[100:1300] + "y" + LONG[50:150]), (8, None), (9, "é" * 80), (10, "é" * 70),
    ]
    expected = brute.without_repeats(rows)
    for hot in (suffix_dedup.HOT_RUNS, 0):  # with windows in one group, and spread
        suffix_dedup.HOT_RUNS, before = hot, suffix_dedup.HOT_RUNS
        try:
            found = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        finally:
            suffix_dedup.HOT_RUNS = before
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found} == expected
    twice = [r for r in suffix_dedup.without_repeats(docs).collect() if r["doc_id"] == 5]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_fuzzy_passage(spark):
    passage = [f"p{i}" for i in range(80)]
    edited = [w if i % 13 else "new" for i, w in enumerate(passage)]
    lead, tail = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    rows = [
        (1, " ".join(lead + passage)), (2, " ".join(edited + tail)), (3, " ".join(passage[:30] + lead[:9])),
        (4, " ".join(tail[::-1] + passage)),
    ]
    found = {r["doc_id"]: r for r in chaining.without_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1]["n_removed"] == 0 and found[3]["n_removed"] == 0
    assert 70 <= found[2]["n_removed"] <= 80 and found[2]["text"].endswith(" ".join(tail))
    assert found[4]["n_removed"] == 80 and found[4]["text"].strip() == " ".join(tail[::-1])


def test_spread_seeds_change_nothing(spark, monkeypatch):
    """Seeds that are spread over tasks by a salt lead to the same first document as all others."""
    random = np.random.default_rng(4)
    passage = [f"p{i}" for i in range(70)]
    rows = []
    for i in range(150):
        own = [f"w{int(k)}" for k in random.integers(0, 4000, 120)]
        text = own[:60] + passage + own[60:] if i % 3 else own
        rows.append((1000 - 3 * i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    columns = ("doc_id", "n_removed", "n_spans", "text")

    def result():
        return sorted(map(tuple, chaining.without_passages(docs).select(*columns).collect()))

    seeds = docs.mapInArrow(chaining._seeds(np.zeros(0, np.uint64)), chaining.SEEDS_DDL).select("seed").distinct()
    every = np.sort(np.array([r[0] for r in seeds.collect()], np.int64).view(np.uint64))
    found = {}
    for name, hot in (("none", every[:0]), ("some", every[::3]), ("all", every)):
        monkeypatch.setattr(chaining, "hot_seeds", lambda known, hot=hot: hot)
        found[name] = result()
    assert found["none"] == found["some"] == found["all"]
    assert sum(n > 0 for _, n, _, _ in found["none"]) == 99


def test_a_chain_of_one_run_aligns_as_any_other():
    random = np.random.default_rng(12)
    told = 0
    for _ in range(3000):
        own = random.integers(0, 3, int(random.integers(6, 40))).astype(np.uint32)
        other = random.integers(0, 3, int(random.integers(6, 40))).astype(np.uint32)
        start, first, n = int(random.integers(0, 3)), int(random.integers(0, 3)), int(random.integers(1, 5))
        other[first : first + n] = own[start : start + n]
        one = chaining._align_run(own, other, start, start + n, first)
        full = chaining.align(own, other, 0, [start, start + n, first, start + n, start + n, first + n])
        if one is not None:
            told += 1
            assert one == full
    assert told > 2000


def test_exact_passages_with_gaps_between(spark):
    """Two exact passages of one source, however far apart on either side, are cut whole."""
    random, rows = np.random.default_rng(11), []

    def some(name, n):
        return [f"{name}{int(k)}" for k in random.integers(0, 1 << 40, n)]

    for case, (own, other) in enumerate([(a, b) for a in (0, 30, 60, 200, 400) for b in (0, 30, 60, 200, 400)]):
        a, b = some("a", 100), some("b", 100)
        rows.append((2 * case, " ".join(some("x", 40) + a + some("x", other) + b + some("x", 40))))
        rows.append((2 * case + 1, " ".join(some("y", 40) + a + some("y", own) + b + some("y", 40))))
    blocks = [some("c", 300) for _ in range(3)]
    rows.append((1000, " ".join(w for b in blocks for w in b)))
    rows.append((1001, " ".join(w for b in blocks for w in b + some("z", 120))))
    expected = brute.repeated_words(rows)
    found = chaining.without_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = {r["doc_id"]: set(brute.words(r["text"])) for r in found}
    texts = {i: brute.words(t) for i, t in rows}
    for i, places in expected.items():
        assert not left[i] & {texts[i][j] for j in places}, i
        assert i % 2 or left[i] == set(texts[i])


def test_recall_of_passages_with_changed_words(spark):
    """Planted passages of 100 words of which a share, or every so-manieth, is another one."""
    random, rows, planted = np.random.default_rng(12), [], {}

    def some(n):
        return [f"w{int(k)}" for k in random.integers(0, 5000, n)]

    def similar(equal):  # brute force: 50 words in a row of which 80 % are equal
        total = np.concatenate([[0], np.cumsum(100 * equal - 80)])
        return any((total[i + 50 :] >= total[i]).any() for i in range(len(total) - 50))

    for kind in (0.05, 0.1, 0.15, 0.2, 8, 7, 6):
        for _ in range(60):
            a = some(100)
            equal = random.random(100) >= kind if kind < 1 else np.arange(100) % kind != kind // 2
            b = [w if e else f"new{random.integers(1 << 40)}" for w, e in zip(a, equal, strict=True)]
            rows.append((len(rows), " ".join(some(40) + a + some(40))))
            if similar(equal.astype(int)):
                planted.setdefault(kind, []).append(len(rows))
            rows.append((len(rows), " ".join(some(40) + b + some(40))))
    found = chaining.without_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    cut = {r["doc_id"]: r["n_removed"] for r in found}
    for kind, ids in planted.items():
        assert np.mean([cut[i] >= 50 for i in ids]) >= (0.9 if kind == 0.2 else 0.95), kind
    assert sum(cut[i] for i in range(0, len(rows), 2)) == 0


def test_parts_of_a_chain_by_brute_force():
    """The longest stretches of aligned words that reach PERCENT, by looking at all of them."""
    random = np.random.default_rng(4)
    for _ in range(200):
        n = int(random.integers(1, 12))
        begin = [tuple(random.integers(-9, 9, 2).tolist()) for _ in range(n)]
        finish = [tuple(random.integers(-9, 9, 2).tolist()) for _ in range(n)]
        expected = [max((j for j, f in enumerate(finish) if f[0] >= b[0] and f[1] >= b[1]), default=-1) for b in begin]
        assert chaining._furthest(begin, finish) == expected


def test_chains_by_brute_force():
    random = np.random.default_rng(3)
    for _ in range(50):
        n = int(random.integers(2, 9))
        start = np.sort(random.integers(0, 60, n))
        first = random.integers(0, 60, n)
        end = start + random.integers(5, 9, n)

        def value(chain):
            total = 0.0
            for k, i in enumerate(chain):
                gap = 0.0
                if k:
                    j = chain[k - 1]
                    if end[j] > start[i] or first[j] + end[j] - start[j] > first[i]:
                        return -1e9
                    gap = chaining.GAP * (start[i] - end[j] + first[i] - first[j] - end[j] + start[j])
                total += end[i] - start[i] - gap
            return total

        def best(last):
            options = [best(j)[1] + [last] for j in range(n) if end[j] <= start[last] and first[j] + end[j] - start[j] <= first[last]]
            top = max([[last], *options], key=value)
            return value(top), top

        found = chaining.chains(start, end, first)
        assert sorted(i for c in found for i in c) == list(range(n))
        assert value(found[0]) == pytest.approx(max(best(i)[0] for i in range(n)))


def test_packing_search():
    random = np.random.default_rng(2)
    for _ in range(40):
        counts = np.zeros(33, np.int64)
        for size in random.integers(1, 33, 40):
            counts[size] += int(random.integers(1, 4))
        plan = packing.complete(counts, 32)
        used = np.zeros(33, np.int64)
        for pattern, bins in plan:
            assert sum(s * k for s, k in pattern) <= 32
            for s, k in pattern:
                used[s] += k * bins
        assert (used == counts).all()
        fewest = packing.lower_bound(counts, 32)
        assert fewest <= sum(n for _, n in plan) <= sum(n for _, n in packing.best_fit(counts, 32))


def test_tokens_are_those_of_the_slow_tokenizer():
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(tokenizer_path())
    for text in ["", " ", "a\n\n b\t\tc  ", "Ünï 日本 🙂🙂", "it's <|endoftext|> here", "x" * 3000, "\r\n   9.99%", LONG[:5000]]:
        assert packing.token_ids(text, tokenizer_path()).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_ablations(spark):
    texts = ["word " * 5, "### *** && " * 20, SENTENCE * 20, " ".join(f"good{i}" for i in range(60))]
    rows = quality.ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    judged = {r["doc_id"]: r["kept"] for r in quality.apply_policy(rows).collect()}
    assert judged == {0: False, 1: False, 2: False, 3: True}
    found = {r["rule"]: tuple(r)[1:] for r in quality.ablations(rows).collect()}
    assert found["few_words"] == (1, 1, 2) and found["symbols"][0] == 1 and found["capitals"] == (0, 0, 1)


def test_mixed_language(spark):
    rows = [(1, "abc abd acd " * 60, "en"), (2, "xyz xzw yzw " * 60, "de"), (3, "abc abd " * 20 + "xyz xzw " * 30, None)]
    found = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(False))
    mixed = found.where("doc_id = 3").first()
    assert [s["lang"] for s in mixed["spans"]] == ["en", "de"]
    assert mixed["lang_pred"] == "de" and mixed["score"] == pytest.approx(0.6)


def test_scripts_narrow_languages(spark):
    rows = [(1, "привет мир " * 9, "ru"), (2, "hello world " * 9, "en"), (3, "мир hello", None), (4, "日本", None)]
    found = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(False))
    by = {r["doc_id"]: r for r in found.collect()}
    assert by[1]["lang_pred"] == "ru" and by[2]["lang_pred"] == "en" and by[4]["lang_pred"] in ("ru", "en")


@pytest.mark.parametrize("toxic", [0, 1])
def test_long_labelled_text_leaves_the_others(spark, toxic):
    """A class's first text in the sample's order has more characters than the sample may have."""
    order = [r[0] for r in spark.range(120).orderBy(F.xxhash64("id"), "id").collect()]
    labels = {i: k % 2 for k, i in enumerate(order)}
    if toxic:
        labels = {i: 1 - c for i, c in labels.items()}
    words = (["good", "fine", "calm", "nice"], ["vile", "nasty", "awful", "cruel"])
    random = np.random.default_rng(8)
    rows = []
    for k, i in enumerate(order):
        n = toxicity.SAMPLE_CHARS[toxic] // 4 if k == 0 else 40
        rows.append((i, " ".join(np.array(words[labels[i]])[random.integers(0, 4, n)])))
    assert labels[order[0]] == toxic and len(rows[0][1]) > toxicity.SAMPLE_CHARS[toxic]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    texts, classes, odds = toxicity.labelled_sample(docs, marks, F.lit(False))
    assert len(texts) == 120 and classes.sum() == 60 and odds == 1
    assert all(sum(len(t) for t, c in zip(texts, classes, strict=True) if c == k) <= toxicity.SAMPLE_CHARS[k] for k in (0, 1))
    found = toxicity.score_toxicity(docs, marks, F.lit(False)).collect()
    assert all(r["predicted"] == labels[r["doc_id"]] for r in found)


def test_more_toxic_labels_in_the_sample_than_there_are(spark, monkeypatch):
    """The sample holds all toxic and few ordinary documents; the shares of all labels decide what is predicted."""
    random = np.random.default_rng(3)
    rows, labels = [], {}
    for i in range(1800):
        words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in random.integers(0, 300, 60)]
        labels[i] = int(i % 9 == 0)
        if labels[i] or i % 30 == 1:  # a word that few ordinary documents have, too
            words[int(random.integers(0, 60))] = "vile"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    held_out = F.col("doc_id") % 5 == 0
    for sample in ((6000, 2000), (250, 200)):
        monkeypatch.setattr(toxicity, "SAMPLE_DOCS", sample)
        _, classes, odds = toxicity.labelled_sample(docs, marks, held_out)
        assert odds == pytest.approx((classes == 0).sum() / classes.sum() / 8)
        found = toxicity.score_toxicity(docs, marks, held_out).where("held_out").toPandas()
        toxic = found.doc_id.map(labels) == 1
        assert (found.score[toxic] > found.score[~toxic].quantile(0.9)).mean() > 0.8
        assert abs(found.score.mean() - 1 / 9) < 0.06


def test_fair_share():
    assert toxicity.fair_share([], 9) == 0 and toxicity.fair_share([5, 2], 9) == 5
    assert toxicity.fair_share([100, 2, 3], 9) == 4 and toxicity.fair_share([100, 100, 100], 9) == 3


def test_blocks():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><a href='x>y'>menu</a></nav><!-- <p>no</p> -->"
        "<main><h1>A &amp; B</h1><p>one\n  two<br>three<p><b>four</b></p><script>var t='</p>'</script>"
        "<section class='user-comments'><p>hi</p></section></main><footer>&copy; x</footer></body></html><p"
    )
    found = blocks(page)
    assert [b.text for b in found] == ["T", "menu", "A & B", "one two three", "four", "hi", "© x"]
    assert [b.text for b in found if supposed_main(b.path)] == ["A & B", "one two three", "four"]
    assert blocks(None) == blocks("") == []


def test_extraction_cases(spark):
    page = "<html><body><nav><a>menu</a></nav><article><p>" + SENTENCE + "</p></article></body></html>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", ""), (3, "w", "plain < text & more")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    found = extraction.extract_text(pages)
    by = {(r["page_id"], r["url"]): r["text"] for r in found.collect()}
    assert found.count() == 5 and by[1, "u"] == SENTENCE.strip() and by[2, None] == by[None, "v"] == ""
    assert extraction.extract_text(pages.where("false")).count() == 0


def test_words_at_borders():
    words = Words(pa.array(["a b", None, "c", " d", "E"]))
    assert words.strings(np.arange(5)) == [b"a", b"b", b"c", b"d", b"e"]
    assert words.at.tolist() == [0, 2, 2, 3, 4, 5]
    assert np.diff(shingles(words, 2)[1]).tolist() == [1, 0, 1, 1, 1]
    sliced = pa.record_batch({"text": pa.array(["x", "yy", "zzz"])}).slice(1)
    assert [p.num_rows for p in pieces(sliced)] == [2]
