"""The pipeline over a small corpus with a case planted for every stage."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tallyline.llm.common import stored


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    random.seed(9)
    vocabulary = ["".join(random.choice("abcdefghij") for _ in range(6)) for _ in range(4_000)]

    def prose(n):
        return random.choices(vocabulary, k=n)

    item, passage = prose(30), prose(60)
    bad = ["vilest", "rotten", "wretched", "fools"]
    docs = {i: prose(random.randint(80, 200)) for i in range(300)}
    toxic = {i: int(i % 4 == 3) for i in range(260)}
    for i, y in toxic.items():
        if y:
            for _ in range(4):
                docs[i].insert(random.randrange(len(docs[i])), random.choice(bad))
    docs[300] = list(docs[0])
    docs[301] = prose(40) + passage + prose(40)
    docs[302] = prose(40) + passage + prose(40)
    docs[303] = prose(50) + item + prose(50)
    docs[304] = prose(3_000) + bad * 100
    rows = [(i, " ".join(w), "en", "s", len(" ".join(w))) for i, w in docs.items()]
    rows += [(400, None, None, None, None), (401, "", "", "", 0)]
    path = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    labels = spark.createDataFrame(
        [(i, 1, y) for i, y in toxic.items()], "doc_id long, quality int, toxic int"
    )
    labels.write.parquet(f"{path}/labels.parquet")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    items.write.parquet(f"{path}/benchmark.parquet")
    return path, docs, toxic, passage


def test_stages(spark, folder):
    path, given, toxic, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, path), name)
        assert docs.columns == columns
        kept.append({r.doc_id: r.text for r in docs.collect()})
    after_toxic, after_near, after_cut, clean = kept
    marked = {i for i, y in toxic.items() if y} | {304}
    assert not after_toxic.keys() & marked
    assert len(after_toxic) == 307 - len(marked)
    # Copies of a document and the two without words: the first of each stays.
    assert after_toxic.keys() - after_near.keys() == {300, 401}
    words = " ".join(passage)
    assert words in after_cut[301]
    assert after_cut[302].split() == given[302][:40] + given[302][100:]
    assert all(after_cut[i] == after_near[i] for i in after_near.keys() - {302})
    assert after_cut.keys() - clean.keys() == {303}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {}
    for r in sorted(packed, key=lambda r: (r.doc_id, r.piece)):
        ids.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert ids == {
        i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in clean.items()
    }


def test_run_returns_the_last_stage(spark, folder):
    packed = corpus_pipeline.run(spark, folder[0])
    assert {"sequence_id", "offset", "ids"} <= set(packed.columns)
    assert packed.count() > 200


def odd_folder(spark, path, rows):
    """A corpus of odd rows whose further columns are named like those of the operators."""
    names = "score matches kept kept_text n_words _hash predicted _others"
    schema = "doc_id long, text string, lang string, source string, n_chars long, "
    schema += ", ".join(f"{n} string" for n in names.split())
    full = [(i, t, None, "s", 1, *["own"] * len(names.split())) for i, t in rows]
    spark.createDataFrame(full, schema).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i == 15)) for i in range(20)] + [(None, 1, 1), (1, None, None)]
    schema = "doc_id long, quality int, toxic int"
    spark.createDataFrame(labels, schema).write.parquet(f"{path}/labels.parquet")
    items = [(1, None), (None, "too short"), (2, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet"
    )
    return path


def test_stages_over_odd_rows(spark, odd_rows, tmp_path):
    path = odd_folder(spark, str(tmp_path), odd_rows)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    schema = docs.schema
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, path), name)
        assert docs.schema == schema
        rows = docs.collect()
        assert rows and all(r.score == r.matches == r._others == "own" for r in rows)
    ids = [r.doc_id for r in rows if r.doc_id is not None]
    assert len(ids) == len(set(ids))
    assert any(r.doc_id is None for r in rows)
    assert {r.doc_id: r.text for r in rows}.get(9) in (None, "a")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, path).count() >= len(rows)


def test_an_id_keeps_the_text_that_no_other_has(spark, documents):
    random.seed(4)
    copied, own = ("a " + " ".join(random.choices("uvwxyz", k=60)) for _ in range(2))
    own = "b" + own
    docs = documents([(1, copied), (2, copied), (2, own), (3, None), (4, "")])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, None).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, copied), (2, own), (3, None)]


def test_stages_over_empty_tables(spark, tmp_path):
    path = odd_folder(spark, str(tmp_path), [])
    assert corpus_pipeline.run(spark, path).count() == 0


def test_near_dedup_takes_the_fingerprint_of_a_text_once(spark, documents, capsys):
    docs = documents([(1, "a b c"), (1, "d e f"), (2, "a b c")])
    found = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    found.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
