"""The operators against brute force, exact round trips and awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from larder.llm import chat, common, jaccard, packing, pages, secrets, spans, toxicity
from larder.llm.decontaminate import common_words, find_contamination
from larder.llm.exact_dedup import drop_copies, exact_dedup
from larder.llm.jaccard import drop_near_copies, near_duplicates
from larder.llm.packing import best_fit, pack_documents
from larder.llm.shards import fisher_yates, shard_rows

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls everywhere, empty, long and equal texts, and a row listed twice."""
    rng = random.Random(5)
    base = [words(rng, 60) + ". " + words(rng, 30) + "." for _ in range(12)]
    texts = [None, "", " \t\n", *base, *base[:4], base[0].replace(" ", "  "), words(rng, 30_000)]
    texts += [base[5].replace("a", "b", 1), "one two", "one two", "one\ttwo"]
    rows = [(i, text, None, None, None) for i, text in enumerate(texts)]
    rows += [rows[5], (None, base[1], "en", "s", 1), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return [row.asDict(recursive=True) for row in df.collect()]


def test_exact_dedup_equals_brute_force(awkward):
    rows = rows_of(awkward)
    groups = defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0d]", "", row["text"] or "")].append(row)
    best = {}
    for norm, group in groups.items():
        best[norm] = min(group, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))
    found = rows_of(exact_dedup(awkward))
    assert len(found) == len(rows)
    for row in found:
        norm = re.sub(r"[\x20\x09-\x0d]", "", row["text"] or "")
        keeper = best[norm]
        assert row["keep_id"] == keeper["doc_id"] and row["group_size"] == len(groups[norm])
        assert row["kept"] == (row["doc_id"] == keeper["doc_id"] and len(row["text"] or "") == len(keeper["text"] or ""))
    kept = rows_of(drop_copies(awkward))
    assert len(kept) == len(groups) and set(kept[0]) == set(rows[0])


def shingles(text: str | None) -> frozenset:
    found = (text or "").lower().split()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))) if found else frozenset()


def test_near_duplicates_equal_brute_force(spark, awkward, monkeypatch):
    rng = random.Random(3)
    base = words(rng, 120).split()
    texts = []
    for _ in range(90):
        copy = list(base)
        for _ in range(rng.randint(0, 8)):
            copy[rng.randrange(len(copy))] = "x" + str(rng.randrange(50))
        texts.append(" ".join(copy))
    more = spark.createDataFrame([(1000 + i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    docs = awkward.unionByName(more).cache()
    rows = [row for row in rows_of(docs)]
    sets = {}
    for row in rows:
        sets.setdefault(shingles(row["text"]), []).append(row["doc_id"])
    keys = list(sets)
    links = {a: [b for b in keys if a != b and a and b and len(a & b) >= 0.8 * len(a | b)] for a in keys}
    label = {}
    for key in keys:
        stack = [] if key in label else [key]
        while stack:
            one = stack.pop()
            if one not in label:
                label[one] = key
                stack += links[one]
    least = defaultdict(list)
    for key in keys:
        least[label[key]] += [i for i in sets[key] if i is not None]
    by_id = {row["doc_id"]: shingles(row["text"]) for row in rows if row["doc_id"] is not None}
    for block in (512, 16):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        found = rows_of(near_duplicates(docs))
        assert len(found) == len(rows)
        for row in found:
            if row["doc_id"] is not None:
                key = by_id[row["doc_id"]]
                assert row["n_links"] == len(links[key]) and row["copies"] == len(sets[key])
                assert row["class_id"] == min(least[label[key]])
    kept = rows_of(drop_near_copies(docs))
    assert len(kept) == len(set(label.values()))
    assert Counter(label[shingles(row["text"])] for row in kept).most_common(1)[0][1] == 1


def test_pruning_keeps_likely_pairs():
    least = jaccard.least_matches(0.8, 1e-5)
    assert least == sorted(least) and 0 < least[-1] < 0.8 * jaccard.HASHES
    assert jaccard.tail(128, 128, 0.8) > 0.99 > 1e-5 > jaccard.tail(20, 128, 0.8)


def test_shards_are_even_gapless_and_repeatable(spark, awkward, tmp_path):
    docs = awkward.withColumns({"shard": F.lit("mine"), "slot": F.lit(0)})
    first, second = (rows_of(shard_rows(docs, str(tmp_path / str(i)), shards=7, bucket_bytes=50_000)) for i in range(2))
    assert sorted(map(str, first)) == sorted(map(str, second))
    assert Counter(str(r["text"]) for r in first) == Counter(str(r["text"]) for r in rows_of(awkward))
    by = defaultdict(list)
    for row in first:
        by[row["shard"]].append(row["slot"])
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    assert sorted(fisher_yates(50, np.random.default_rng(1)).tolist()) == list(range(50))
    assert shard_rows(docs.limit(0), str(tmp_path / "none")).count() == 0


def test_packing_round_trip(spark, awkward):
    from tokenizers import Tokenizer
    import public_tokenizers

    extra = spark.createDataFrame(
        [(500, "It's 12,5% of «Straße» İstanbul ΣΑΣ été!!!   x\x1cy <|endoftext|> a_b it's", None, None, None)], SCHEMA
    )
    docs = awkward.unionByName(extra)
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = Counter()
    for row in rows_of(docs):
        ids = np.array(encoder.encode(row["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            wanted[row["doc_id"], piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    found = rows_of(pack_documents(docs))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == wanted
    by = defaultdict(list)
    for row in found:
        by[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(by) == -(-sum(r["length"] for r in found) // 4096)
    assert pack_documents(docs.limit(0)).count() == 0


def test_bulk_steps_equal_one_by_one():
    rng = random.Random(8)
    for _ in range(30):
        lengths = [rng.choice([1, 2, 3, 5, 17, 40, 60, 99, rng.randint(1, 100)]) for _ in range(200)]
        gaps: list[int] = []
        for length in sorted(lengths, reverse=True):
            fitting = [g for g in gaps if g >= length]
            if fitting:
                gaps.remove(min(fitting))
                gaps.append(min(fitting) - length)
            else:
                gaps.append(100 - length)
        assert best_fit(Counter(lengths), 100)[1] == len(gaps)


def test_spans(spark):
    rng = random.Random(2)
    passage = ". ".join(words(rng, 14) for _ in range(5)) + "."
    own = [". ".join(words(rng, 12) for _ in range(6)) + "." for _ in range(4)]
    texts = [own[0] + "\n" + passage + "\n" + own[1], own[2] + "\n" + passage, passage + " " + own[3] + "\n" + passage, "Hi. Ho. Ha.", "Hi. Ho. Ha."]
    docs = spark.createDataFrame([*enumerate(texts), (None, passage), (9, None), (9, "")], "doc_id bigint, text string")
    found = {row["doc_id"]: row for row in spans.remove_repeats(docs).collect()}
    assert found[0]["text"] != texts[0] and passage not in found[0]["text"] and own[0] in found[0]["text"]
    assert found[1]["text"].strip() == own[2] and found[2]["text"].strip() == own[3]
    assert found[None]["text"] == passage and found[9]["text"] == ""
    assert found[3]["text"] == found[4]["text"] == texts[3]
    cut = found[1]["removed"][0]
    assert passage in texts[1][cut["start"] : cut["end"]]
    assert spans.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("glue", [" ", ""])
def test_spans_planted_within_sentences(spark, glue):
    rng = random.Random(33)
    word = (lambda: words(rng, 1)) if glue else (lambda: chr(rng.randrange(0x4E00, 0x9FA0)))
    rows, passages = [], []
    for i in range(40):
        passage = glue.join(word() for _ in range(100))
        for first in (3, 5 + i % 16):
            rows.append((len(rows), glue.join([*(word() for _ in range(first)), passage, *(word() for _ in range(i % 7))])))
        passages.append(passage)
    found = spans.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    found = {row["doc_id"]: row for row in found}
    for i, passage in enumerate(passages):
        assert found[2 * i]["n_removed"] == 0
        text, later = rows[2 * i + 1][1], found[2 * i + 1]
        start = text.index(passage)
        assert later["n_removed"] >= 0.7 * len(passage)
        assert all(start <= cut["start"] and cut["end"] <= start + len(passage) + 1 for cut in later["removed"])


def test_decontamination(spark):
    rng = random.Random(4)
    items = [words(rng, n) + ". " + words(rng, 6) + "." for n in (16, 30, 50, 90)]
    clean = [words(rng, 200) for _ in range(20)]
    changed = items[2].split()
    for i in range(0, 40, 5):
        changed[i] = "zzz"
    texts = [*clean, *(f"{a} {b} {a}" for a, b in zip(clean, items)), clean[0] + " " + " ".join(changed), None, ""]
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "doc_id bigint, text string, items string")
    bench = spark.createDataFrame([*enumerate(items), (7, None), (None, "x"), (8, "")], "item_id bigint, text string")
    found = {row["doc_id"]: row["items"] for row in find_contamination(docs, bench).collect()}
    assert {i: x for i, x in found.items() if x} == {20: [0], 21: [1], 22: [2], 23: [3], 24: [2]}
    assert not any(row["contaminated"] for row in find_contamination(docs, bench.limit(0)).collect())


def test_decontamination_finds_copies_of_a_large_benchmark_in_few_dimensions(spark):
    rng = random.Random(31)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=40))) for i in range(2000)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=25)) + " own " + text + " end " + " ".join(rng.choices(vocabulary, k=25))) for i, text in items[::20]]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = find_contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), bench, dims=16)
    assert {row["doc_id"]: row["items"] for row in found.collect()} == {i: [i] for i, _ in docs}


def test_decontamination_finds_edited_items_among_many_documents(spark):
    rng = random.Random(32)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=40))) for i in range(30)]
    edited = []
    for i, text in items:
        gone = set(rng.sample(range(40), 16))
        edited.append((i, " ".join(f"new{i}x{k}" if k in gone else word for k, word in enumerate(text.split()))))
    others = [(1000 + i, " ".join(rng.sample(vocabulary, 60))) for i in range(3000)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for docs in (edited, edited + others):
        found = find_contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), bench).where("doc_id < 1000")
        assert {row["doc_id"]: row["items"] for row in found.collect()} == {i: [i] for i, _ in items}


def test_common_subsequence_equals_dynamic_programming():
    rng = random.Random(6)
    for _ in range(100):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert common_words(a, b) == table[-1][-1]


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/labels.parquet")
    model = toxicity.fit_toxicity(toxicity.labelled_rows(docs, labels))
    scored = toxicity.score_toxicity(docs, model).join(labels, "doc_id").where(toxicity.held_out("doc_id")).collect()
    assert sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in scored) >= 0.95 * len(scored)
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "!!! ..."), (3, "a" * 200_000)], "doc_id bigint, text string")
    assert [r["score"] for r in toxicity.score_toxicity(odd, model).collect()][:3] == [0.0, 0.0, 0.0]
    assert toxicity.fit_toxicity(odd.limit(0).withColumn("toxic", F.lit(1))) == {"": -30.0}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>
<div class="cookie-notice">We use cookies here and there</div><aside class=x>Side words that go on</aside>
<div id="content"><h1>Head &amp; line</h1><p>First   <b>bold</b>&nbsp;text here for you.<p>Second paragraph with some words<br>more.</p>
<div class="ad">Buy now</div><p>x</p><ul><li>One item</li><li>Two</li></ul></div>
<form><input name=q><button>Go</button></form><section id="comments"><p>Nice post by a reader!</p></section>
<footer>&copy; all</footer></body></html>"""


def test_pages(spark):
    rows = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (4, "u", "<p>only &lt;one&gt; <!-- no"), (None, "u", "<div><a hre")]
    pages_df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    labelled = spark.read.parquet(f"{SMALL}/pages.parquet")
    found = {r["page_id"]: r for r in pages.extract_pages(pages_df, pages.fit_weights(labelled)).collect()}
    assert found[1]["text"] == (
        "Head & line\n\nFirst bold text here for you.\n\nSecond paragraph with some words more.\n\nx\n\nOne item\n\nTwo"
    )
    assert found[1]["n_chars"] == len(found[1]["text"])
    assert found[2]["text"] == found[3]["text"] == found[None]["text"] == "" and found[4]["text"] == "only <one>"


def test_page_names_are_learnt(spark):
    body = "<p>" + "plain words of the text " * 10 + "</p>"
    page = f'<html><body><div class="zebra">Buy this thing today</div><div>Unmarked advert of six words</div><article>{body}</article></body></html>'
    weights = pages.fit_weights(spark.createDataFrame([(page,)] * 300, "html string"))
    kept = "".join(f"<section {name}><h2>Part</h2><p>Kept {name[-8:-1]} words</p></section>" for name in ('id="discussion"', 'id="related-work"', 'class="side-by-side"'))
    text = pages.extract(f'<html><body><div>Unmarked advert of six words</div><article>{body}{kept}<div class="zebra">Buy more</div>{body}</article></body></html>', weights)
    assert "ussion words" in text and "ed-work words" in text and "by-side words" in text
    assert "Buy" not in text and "Unmarked" not in text


def test_secrets(spark):
    text = 'Password: "abcdefgh1" x ſecret=aaaaaaaaaa TOKEN=short AKIA' + "A1" * 6 + " " + "0af" * 11 + " login: k9$Xq!27zPw# pwd=qwertyuiop"
    docs = spark.createDataFrame([(1, text), (2, None), (None, "")], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in secrets.find_secrets(docs).collect()}
    one = found[1]
    assert (one["n_assign"], one["n_access"], one["n_hex"], one["n_guess"]) == (1, 1, 1, 1)
    base = [s for s in one["spans"].split(",") if not s.startswith("guess")]
    assert one["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
    kind, start, end = one["spans"].split(",")[-1].split(":")
    assert kind == "guess" and text[int(start) : int(end)] == "k9$Xq!27zPw#"
    assert found[2]["spans"] == "" and found[None]["n_hex"] == 0
    ranks = {"password": 0, "horse": 50}
    cost = lambda value: secrets.log_guesses(value, ranks)
    assert cost("password1990") < cost("horsepassword") + 3 < cost("xk9f2mq7wz31")
    assert cost("qwertyuiop") < 7 < secrets.brute("qwertyuiop") and cost("aaaaaaaaaaaa") < 4 and cost("") == 0


def test_segments_of_any_start_period_and_date_order():
    ranks = {"password": 0, "pass": 1, "horse": 50}
    cost = lambda value: secrets.log_guesses(value, ranks)
    for date in ("12/31/1999", "31.12.1999", "31121999", "12-1999"):
        assert cost(date) < 6
    assert cost("horsert" + "yuiop") < cost("horse") + 5 and cost("passsssss") < cost("pass") + 4
    assert cost("k9x2q" * 4) <= cost("k9x2q") + 1
    assert cost("ab" * 4000) < cost("ab") + 4000 and cost("password1990") < 6


def test_chat(spark):
    call = '<tool_call>{"id": "c1", "name": "add", "arguments": {"b": 2, "a": 1}}</tool_call>'
    bad = '<tool_call>{"id": "c2", "name": "add", "arguments": {"a": "x"}}</tool_call><tool_call>{oops</tool_call>'
    rows = [
        (1, 0, "user", "Hé?"), (1, 1, "tool", '{"tool_call_id": "c1", "content": 3}'), (1, 2, "assistant", "So " + call + bad),
        (1, 3, "assistant", None), (2, None, None, '<tool_result>{"id": "zz", "content": null}</tool_result>'), (None, 0, "user", "x"),
        (None, 0, "user", "x"),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    schema = {"add": {"type": "object", "properties": {"a": {"type": "integer"}, "b": {"type": "integer"}}, "required": ["a", "b"]}}
    found = {(r["conv_id"], r["position"]): r for r in chat.format_chats(turns, schema).collect()}
    assert len(found) == len(rows)
    assert [found[1, i]["turn"] for i in range(4)] == [0, 2, 1, 3]
    assert (found[1, 1]["n_calls"], found[1, 1]["n_invalid"], found[1, 2]["n_linked"]) == (3, 2, 1)
    assert found[1, 0]["message"] == '{"content":"Hé?","role":"user"}'
    assert found[1, 2]["message"] == '{"content":"","role":"tool","tool_results":[{"content":3,"id":"c1","linked":true}]}'
    assert '{"arguments":{"a":1,"b":2},"id":"c1","name":"add","valid":true}' in found[1, 1]["message"]
    assert found[2, 0]["n_linked"] == 0 and found[2, 0]["role"] == ""


def test_chat_chains_and_cycles(spark):
    def text(calls: str, results: str) -> str:
        made = "".join(f'<tool_call>{{"id":"{c}","name":"f","arguments":{{}}}}</tool_call>' for c in calls)
        return made + "".join(f'<tool_result>{{"id":"{r}","content":1}}</tool_result>' for r in results)

    chats = {
        1: [(1, "", ""), (4, "C", "A"), (5, "", "C"), (6, "A", ""), (7, "", "")],
        2: [(2, "", "B"), (3, "B", "A"), (5, "A", ""), (6, "", "")],
        3: [(1, "A", "B"), (2, "B", "A"), (3, "", "B"), (4, "", "")],
        4: [(1, "", "D"), (2, "D", "C"), (3, "C", "B"), (4, "B", "A"), (5, "A", "A"), (6, "", "A")],
    }
    rows = [(c, n, "tool", text(made, got)) for c, turns in chats.items() for n, made, got in turns]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    order = defaultdict(list)
    for row in sorted(chat.format_chats(turns).collect(), key=lambda row: (row["conv_id"], row["position"])):
        assert row["position"] == len(order[row["conv_id"]])
        order[row["conv_id"]].append(row["turn"])
    assert order == {1: [1, 6, 4, 5, 7], 2: [5, 3, 2, 6], 3: [1, 2, 3, 4], 4: [5, 4, 3, 2, 1, 6]}


def test_chat_reads_tools_from_system_turns(spark):
    tools = '<tools>[{"name":"f","parameters":{"type":"object","required":["x"],"properties":{"x":{"type":"integer"}}}},{"name":"g","parameters":{"type":"odd"}}]</tools>'
    call = lambda name, arguments: f'<tool_call>{{"id":"1","name":"{name}","arguments":{arguments}}}</tool_call>'
    calls = [call("f", '{"x":1}'), call("f", '{"x":"1"}'), call("f", "{}"), call("g", "{}"), call("h", "{}"), call("f", "[]")]
    rows = [(c, n, "a", text) for c in (1, 2) for n, text in enumerate(calls, 1)]
    rows += [(1, 0, "system", tools), (2, 0, "user", tools)]
    found = chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")).collect()
    found = {(r["conv_id"], r["turn"]): r["n_invalid"] for r in found}
    assert [found[1, n] for n in range(7)] == [0, 0, 1, 1, 1, 1, 1] and [found[2, n] for n in range(7)] == [0, 0, 0, 0, 0, 0, 1]


def test_pipeline_decisions_take_effect(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    texts = [re.sub(r"\s", "", row["text"]) for row in docs.collect()]
    assert len(set(texts)) == len(texts)
    packed = corpus_pipeline.packing(spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_batches_are_bounded_unless_the_session_says_otherwise(spark):
    before = spark.conf.getAll.get(common.BATCH_SETTING)
    try:
        spark.conf.set(common.BATCH_SETTING, "9m")
        common.bounded_batches(spark)
        assert spark.conf.get(common.BATCH_SETTING) == "9m"
        spark.conf.unset(common.BATCH_SETTING)
        common.bounded_batches(spark)
        assert spark.conf.get(common.BATCH_SETTING) == common.BATCH_LIMIT
    finally:
        if before is not None:
            spark.conf.set(common.BATCH_SETTING, before)
