"""The queries of the corpus operators on whole test tables, against SQL, brute force or held-out labels."""

from __future__ import annotations

import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as contract
from tallyvault.llm import decontamination, toxicity
from tallyvault.llm import queries as llm
from tallyvault.llm.blocks import blocks, supposed_main
from tests.llm import brute

DATA = Path("/root/testdata/sf0.001")
LARGER = Path("/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


def table(name: str, data: Path = DATA):
    return duckdb.sql(f"SELECT * FROM '{data}/{name}.parquet'").df()


def texts(data: Path = DATA) -> list[tuple[int, str]]:
    return list(table("documents", data)[["doc_id", "text"]].itertuples(index=False, name=None))


def test_all_are_registered():
    names = contract.queries()
    assert {n.split("_")[0] for n in llm.registry()} == {f"op{k}" for k in range(1, 14)}
    assert llm.registry().keys() <= names.keys() and "pipeline" in names


def test_language(spark):
    found = llm.op1_language_id(spark, str(LARGER)).toPandas().merge(table("documents", LARGER), on="doc_id")
    held = found[found.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.99
    assert found.score.between(0, 1).all()


@pytest.mark.parametrize("name", sorted(llm.statements()))
def test_same_rows_as_sql(spark, name):
    connection = duckdb.connect()
    for file in LARGER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    expected = connection.execute(llm.statements()[name])
    names = [column[0] for column in expected.description]
    found = llm.registry()[name](spark, str(LARGER))
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*names).collect()), key=repr) == sorted(expected.fetchall(), key=repr)


def test_extraction(spark):
    found = llm.op3_html_extraction(spark, str(DATA)).toPandas().merge(table("pages"), on="page_id")
    for text, n, html in found[["text", "n_chars", "html"]].itertuples(index=False):
        assert text == "\n".join(b.text for b in blocks(html) if supposed_main(b.path))
        assert n == len(text)


def test_passages_that_repeat_are_cut(spark):
    found = llm.op4_substring_dedup(spark, str(DATA)).toPandas().set_index("doc_id")
    seen: dict[tuple, int] = {}
    for i, text in sorted(texts()):
        w = brute.words(text)
        runs = [tuple(w[k : k + 50]) for k in range(len(w) - 49)]
        repeated = {j for k, run in enumerate(runs) if seen.get(run, i) != i for j in range(k, k + 50)}
        for run in runs:
            seen.setdefault(run, i)
        assert found.n_words[i] == len(w)
        assert found.n_removed[i] >= len(repeated)


def test_packing(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(llm.tokenizer_path())
    found = llm.op5_best_fit_packing(spark, str(DATA)).toPandas()
    total = 0
    for i, text in texts():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        mine = found[found.doc_id == i].sort_values("piece")
        assert mine.start.tolist() == [0, *mine.length.cumsum().tolist()][:-1]
        assert mine.length.sum() == len(ids) and mine.length.iloc[1:].eq(1024).all()
        for start, length, crc in mine[["start", "length", "ids_crc32"]].itertuples(index=False):
            assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
        total += len(ids)
    for _, group in found.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group.offset.tolist() == [0, *group.length.cumsum().tolist()][:-1]
        assert group.length.sum() <= 1024
    assert found.sequence_id.nunique() <= -(-total // 1024) + 1


def test_suffix_dedup(spark):
    expected = brute.without_repeats(texts())
    found = llm.op6_suffix_array_dedup(spark, str(DATA)).toPandas()
    assert {r[0]: tuple(r[1:]) for r in found.itertuples(index=False)} == expected


def test_toxicity(spark):
    """Held-out documents: of those labelled toxic, how many score above 90 of 100 ordinary ones."""
    larger = Path("/root/testdata/sf0.1")
    found = llm.op7_toxicity(spark, str(larger)).toPandas().merge(table("labels", larger), on="doc_id")
    held = found[found.held_out]
    toxic = held.toxic == 1
    assert (held.score[toxic] > held.score[~toxic].quantile(0.9)).mean() > 0.9
    assert (held.predicted == held.toxic).mean() > 0.95


@pytest.mark.parametrize("toxic, ordinary, least", [(88, 2803, 0.85), (352, 704, 0.85), (352, 2803, 0.9)])
def test_toxicity_of_other_class_shares(toxic, ordinary, least):
    """More toxic labels beside the same ordinary ones, or the other way round."""
    larger = Path("/root/testdata/sf0.1")
    rows = table("documents", larger).merge(table("labels", larger), on="doc_id").dropna(subset=["toxic", "text"])
    held = rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    recalls = []
    for draw in range(3):
        learnt = rows[~held].sample(frac=1, random_state=draw)
        few = [learnt[learnt.toxic == c].head(n) for c, n in ((0, ordinary), (1, toxic))]
        both = np.random.default_rng(draw).permutation(np.concatenate([f.index for f in few]))
        learnt = rows.loc[both]
        scorer = toxicity.Scorer(learnt.text.tolist(), learnt.toxic.to_numpy().astype(int))
        score = scorer.scores(toxicity.letters(pa.array(rows[held].text.tolist(), pa.string())))
        of = rows[held].toxic.to_numpy() == 1
        recalls.append((score[of] > np.quantile(score[~of], 0.9)).mean())
    assert np.mean(recalls) >= least


def test_ngram_join(spark):
    found = llm.op8_ngram_jaccard_join(spark, str(LARGER)).toPandas()
    got = {d: (n, c) for d, n, c in found[["doc_id", "n_shingles", "component_id"]].itertuples(index=False)}
    assert got == brute.similar_classes(texts(LARGER))


def test_minhash_dedup(spark):
    found = llm.op11_minhash_dedup(spark, str(LARGER)).toPandas()
    got = {d: (n, c) for d, n, c in found[["doc_id", "n_shingles", "component_id"]].itertuples(index=False)}
    assert got == brute.similar_classes(texts(LARGER), size=4)
    assert found.kept.equals(found.doc_id == found.component_id)


def test_decontamination(spark):
    found = llm.op9_benchmark_decontamination(spark, str(LARGER)).toPandas().set_index("doc_id")
    items = {i: " ".join(brute.words(t)) for i, t in table("benchmark", LARGER)[["item_id", "text"]].itertuples(index=False)}
    wrong = 0
    for i, text in texts(LARGER):
        line = f" {' '.join(brute.words(text))} "
        held = {k for k, item in items.items() if f" {item} " in line}
        assert held <= set(found.item_ids[i])
        wrong += bool(set(found.item_ids[i]) - held)
    assert wrong <= 3  # items that stand there with some words changed


def test_items_with_one_changed_word(spark):
    """Every item of sf0.1 with any one word changed, among other words; its question or answer alone is none."""
    random = np.random.default_rng(6)
    items = table("benchmark", Path("/root/testdata/sf0.1"))[["item_id", "text"]].drop_duplicates("text")
    parts = [decontamination.question_answer(t) for t in items.text]
    vocabulary = sorted({w for t in items.text for w in brute.words(t)})

    def among(words: list[str]) -> str:
        around = [vocabulary[k] for k in random.integers(0, len(vocabulary), 60)]
        return " ".join(around[:30] + words + around[30:])

    rows, expected, others = [], {}, {}
    for i, text in items.itertuples(index=False):
        words = brute.words(text)
        for at in range(len(words)):
            expected[len(rows)] = i
            rows.append((len(rows), among([*words[:at], f"new{at}", *words[at + 1 :]])))
    for i, (question, answer) in zip(items.item_id, parts, strict=True):
        for part in (question, answer) if answer else ():
            others[len(rows)] = i
            rows.append((len(rows), among(brute.words(part) + [f"other{k}" for k in range(12)])))
        others[len(rows)] = i
        rows.append((len(rows), among(random.permutation(brute.words(question + answer)).tolist())))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_contamination(spark.createDataFrame(rows, "doc_id long, text string"), benchmark)
    held = {r["doc_id"]: r["item_ids"] for r in found.collect()}
    assert [d for d, i in expected.items() if i not in held[d]] == []
    assert [d for d, i in others.items() if i in held[d]] == []


def test_context_tree(spark):
    found = llm.op10_lm_scoring(spark, str(DATA)).toPandas().set_index("doc_id")
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts()}
    tree = brute.ContextTree([t for i, t in texts() if not held[i]])
    assert sum(10 ** tree.log10(b" th", byte) for byte in range(256)) == pytest.approx(1)
    for i, text in texts():
        row = found.loc[i]
        assert row.held_out == held[i]
        assert row.n_tokens == len(brute.words(text)) + 1
        assert row.n_known == sum(tree.tokens[w] > 0 for w in brute.words(text)) + 1
        assert row.train_tokens == sum(tree.tokens.values()) + tree.texts
        assert row.base_score == pytest.approx(tree.base(text), rel=1e-9)
        assert row.score == pytest.approx(tree.score(text), rel=1e-9)


def test_pipeline(spark):
    """Stages by brute force where they are exact; the cut texts come from the stage itself."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    steps = []
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = spark.createDataFrame(stage(spark, docs, str(DATA)).toPandas(), docs.schema)
        assert docs.columns == corpus_pipeline.COLUMNS
        steps.append({r["doc_id"]: r["text"] for r in docs.collect()})
    language, unique, cut, clean = steps
    assert language.keys() == dict(texts()).keys()
    classes = brute.similar_classes(list(language.items()))
    assert unique == {i: t for i, t in language.items() if classes[i][1] == i}
    assert cut.keys() <= unique.keys()
    items = [" ".join(brute.words(t)) for t in table("benchmark").text]
    dirty = {i for i, t in cut.items() if any(f" {x} " in f" {' '.join(brute.words(t))} " for x in items)}
    assert clean.keys() <= cut.keys() - dirty and len(clean) >= len(cut) - len(dirty) - 2
    packed = corpus_pipeline.run(spark, str(DATA)).toPandas()
    assert set(packed.doc_id) == clean.keys()
