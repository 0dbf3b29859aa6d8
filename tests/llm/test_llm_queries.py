"""The registered queries against their SQL, and that every operator has one."""

import hashlib
import os
import re

import pytest
import tiktoken

import __spark_entry__ as contract
from checks.compare import difference, duck
from clickloom.llm import byte_bpe
from clickloom.llm import queries as Q
from clickloom.llm.common import table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def test_every_operator_has_a_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in Q.QUERIES)
    assert numbers == list(range(1, 14)) and set(Q.ORACLES) <= set(Q.QUERIES)
    assert {*Q.QUERIES, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_equals_sql(spark, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    want = duck(FOLDER).execute(contract.oracle_sql()[name]).df()
    want = want.astype({c: "float64" for c, kind in want.dtypes.items() if str(kind) == "Int64"})  # as Spark gives nulls
    assert difference(got, want) is None


COLUMNS = {
    "op2": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op9": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
            "base_score": "double", "score": "double"},
    "op11": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
}


@pytest.mark.parametrize("number", sorted(COLUMNS))
def test_columns_of_the_contract(spark, number):
    name = next(n for n in Q.QUERIES if n.startswith(f"{number}_"))
    found = contract.queries()[name](spark, FOLDER)
    kinds = dict(found.dtypes)
    assert {c: kinds[c] for c in COLUMNS[number]} == COLUMNS[number]
    assert found.select("doc_id").distinct().count() == found.count() == 200


def test_tokens_are_those_of_the_library(spark):
    library = tiktoken.Encoding("own", pat_str=Q.PATTERN, mergeable_ranks=byte_bpe.read_ranks(Q.RANKS), special_tokens={})
    sha = lambda data: hashlib.sha256(data).hexdigest()
    want = set()
    for row in table(spark, FOLDER, "documents").collect():
        text = row["text"] or ""
        ids = library.encode_ordinary(text)
        want.add((row["doc_id"], len(ids), sha(",".join(map(str, ids)).encode()), sha(text.encode())))
    assert {tuple(r) for r in contract.queries()["op11_byte_bpe"](spark, FOLDER).collect()} == want


@pytest.mark.parametrize("name, kinds", [
    ("op12_prefix_trie", "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens:bigint ends_sha256:string"),
    ("op13_hard_negatives", "anchor_id positive_id:bigint rank:int negative_id positive_score negative_score:bigint"),
])
def test_kinds_of_the_new_results(spark, name, kinds):
    want, names = {}, []
    for part in kinds.split():
        names.append(part.partition(":")[0])
        if ":" in part:
            want |= dict.fromkeys(names, part.partition(":")[2])
            names = []
    assert dict(contract.queries()[name](spark, FOLDER).dtypes) == want
