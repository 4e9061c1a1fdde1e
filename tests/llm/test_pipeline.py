"""The registered queries and the pipeline's stages, each on its predecessor's rows."""

import re
import sys
from pathlib import Path

import cases
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from shelfwise.llm import neardup, queries  # noqa: E402
from shelfwise.llm.common import stored  # noqa: E402


def test_all_are_registered():
    names = set(queries.QUERIES)
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLE_SQL) <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "passages", "mix", "pack"]


@pytest.fixture(scope="module")
def stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], data), name))
    return out


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_clean_documents_stay_and_copies_go(stages):
    docs, known, single = (df.toPandas() for df in stages[:3])
    assert len(known) == len(docs)  # every document is in a language that can be learned
    prints = known["text"].map(lambda t: neardup.fingerprint_of(t or "") & (1 << 64) - 1).tolist()
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least: dict = {}
    for i, d in enumerate(known["doc_id"]):
        least[find(i)] = min(least.get(find(i), d), d)
    assert sorted(single["doc_id"]) == sorted(least.values())


def test_no_passage_is_left_that_was_repeated(stages):
    from test_texts import brute

    single, cut = stages[2].toPandas(), stages[3].toPandas().set_index("doc_id")
    for d, (_, _, _, left) in zip(single["doc_id"], brute(single["text"].tolist())):
        assert cut.loc[d, "text"] == left.decode("utf-8", "ignore")
        assert cut.loc[d, "n_chars"] == len(cut.loc[d, "text"])


def test_mix_takes_one_and_a_half_times_the_words(stages):
    words = lambda df: sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in df.toPandas()["text"])
    assert words(stages[4]) == pytest.approx(1.5 * words(stages[3]), rel=0.02)
    assert set(stages[4].toPandas()["doc_id"]) <= set(stages[3].toPandas()["doc_id"])


def test_pack_holds_every_token(stages):
    from tokenizers import Tokenizer
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for t in stages[4].toPandas()["text"])
    pieces = stages[5].toPandas()
    assert pieces["length"].sum() == want
    per = pieces.groupby("sequence_id")["length"].sum()
    assert per.max() <= 1024 and (1024 - per).sum() < 0.02 * want + 1024


def test_stages_take_odd_rows(spark):
    docs = cases.documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), f"odd-{name}")
        assert docs.count() > 0
    nothing = cases.empty(cases.documents(spark))
    for name, stage in corpus_pipeline.STAGES:
        nothing = stored(stage(spark, nothing, ""), f"none-{name}")
        assert nothing.count() == 0


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n != "pipeline"])
def test_every_query_runs_over_its_whole_table(spark, data, name):
    table = {"op6": "pages", "op8": "pages", "op7": "embeddings"}.get(name.split("_")[0], "documents")
    rows = queries.QUERIES[name](spark, data).toPandas()
    n = spark.read.parquet(f"{data}/{table}.parquet").count()
    key = rows.columns[0]
    assert rows[key].nunique() == n
    if "op9" not in name:
        assert len(rows) == n
    assert not np.asarray(rows.isna().all()).any() or name.startswith(("op8", "op4"))
