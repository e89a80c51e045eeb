"""Names that clash, odd JSON, odd attributes: nothing crashes, nothing is lost."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from larder.llm import chat, pages, toxicity
from larder.llm.decontaminate import find_contamination
from larder.llm.exact_dedup import drop_copies, exact_dedup
from larder.llm.jaccard import drop_near_copies, near_duplicates
from larder.llm.packing import pack_documents
from larder.llm.spans import remove_repeats

ODD_NAMES = ["doc", "hash", "id", "Score", "items", "KEPT", "code", "node", "group", "n", "Overlap", "sentences"]


@pytest.fixture(scope="module")
def clashing(spark):
    long = " ".join(f"word{i}" for i in range(40_000))
    texts = [None, "", "a b c d e f g h", "a b c d e f g h", "A sentence. Another one here.", long, long + " end", " \n"]
    rows = [(i - 2, text) for i, text in enumerate(texts)] + [(None, texts[2]), (None, None), (4, texts[6])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return df.withColumns({name: F.lit(f"own {name}") for name in ODD_NAMES})


def own_columns_stay(df, given):
    assert df.columns == given.columns
    for name in ODD_NAMES:
        assert {row[0] for row in df.select(f"`{name}`").distinct().collect()} <= {f"own {name}"}


@pytest.mark.parametrize("empty", [False, True])
def test_operators_take_columns_of_any_name(spark, clashing, empty):
    df = clashing.limit(0) if empty else clashing
    many = 0 if empty else 11
    benchmark = spark.createDataFrame([(1, "a b c d e f g h"), (None, None)], "item_id bigint, text string")
    assert exact_dedup(df).count() == many
    assert near_duplicates(df).count() == many
    assert toxicity.score_toxicity(df, {"": -30.0}).select("score").count() == many
    assert find_contamination(df, benchmark).select("items").count() == many
    assert pack_documents(df).count() >= many
    assert remove_repeats(df).count() == many
    own_columns_stay(drop_copies(df), df)
    own_columns_stay(drop_near_copies(df), df)


@pytest.mark.parametrize("empty", [False, True])
def test_filtering_stages_return_the_columns_as_they_were(spark, clashing, empty):
    df = clashing.limit(0) if empty else clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        own_columns_stay(stage(spark, df, SMALL), df)
    assert corpus_pipeline.packing(spark, df, SMALL).count() >= df.count()


def test_negative_ids_are_ids(clashing):
    found = {row["doc_id"] for row in near_duplicates(clashing).collect()}
    assert {-2, -1, 0, None} <= found
    kept = {row["doc_id"] for row in drop_near_copies(clashing).collect()}
    assert 0 in kept and 1 not in kept and -2 in kept


def turns(spark, *texts, role="assistant"):
    return spark.createDataFrame([(1, i, role, text) for i, text in enumerate(texts)], "conv_id int, turn int, role string, text string")


def call(body):
    return f"<tool_call>{body}</tool_call>"


def test_odd_json_is_kept_and_not_valid(spark):
    odd = ['{"id": "a", "arguments": {"x": NaN}}', '{"id": "b", "arguments": {"x": 1e999}}', "[" * 200_000, "{", "7" * 5000]
    rows = chat.format_chats(turns(spark, *map(call, odd))).orderBy("turn").collect()
    for row, body in zip(rows, odd):
        (made,) = json.loads(row["message"])["tool_calls"]
        assert row["n_invalid"] == 1 and made["arguments"] == body and not made["valid"]
        json.loads(row["message"], parse_constant=pytest.fail)


def test_half_a_surrogate_pair_stays_escaped(spark):
    body = r'{"id": "\ud800", "name": "f\udfff", "arguments": {"\ud83d": "\ud800", "ok": "😀"}}'
    result = r'<tool_result>{"id": "\ud800", "content": "\udc00"}</tool_result>'
    rows = chat.format_chats(turns(spark, call(body), result)).orderBy("turn").collect()
    assert r"\ud800" in rows[0]["message"] and "\U0001f600" in rows[0]["message"]
    assert json.loads(rows[0]["message"])["tool_calls"][0]["arguments"]["\ud83d"] == "\ud800"
    assert rows[1]["n_linked"] == 1


def test_further_keys_are_kept(spark):
    made = chat.format_chats(turns(spark, call('{"id": 1, "name": "f", "arguments": {}, "type": "function"}'))).first()
    assert json.loads(made["message"])["tool_calls"][0]["more"] == {"type": "function"}
    text = '{"tool_call_id": "1", "content": "x", "is_error": true, "name": "f"}'
    got = chat.format_chats(turns(spark, text, role="tool")).first()
    assert json.loads(got["message"])["tool_results"][0]["more"] == {"is_error": True, "name": "f"}




@pytest.mark.parametrize(
    "attributes",
    ['title="a hidden gem"', 'data-hidden="false"', 'data-role="search"', "title='role=search'", 'x="style=display:none"', "aria-hiddenish"],
)
def test_attributes_are_read_by_name(attributes):
    assert not pages.is_clutter("p", f" {attributes}")


@pytest.mark.parametrize("attributes", ["hidden", 'HIDDEN=""', "role=search", "role = 'navigation'", 'title="x" aria-hidden="true"', 'style="display : none"'])
def test_hidden_elements_are_found(attributes):
    assert pages.is_clutter("p", f" {attributes}")


def test_an_article_inside_a_form_is_kept():
    page = "<form action=x><input name=q><article><p>Some words of the article.</p></article><button>Send</button></form><form><p>Sign up here</p></form>"
    texts = [(text, clutter) for kind, _, text, clutter, *_ in pages.tokens_of(page) if text.strip()]
    assert ("Some words of the article.", False) in texts and ("Send", True) in texts and ("Sign up here", True) in texts
