"""Mixing, packing, top-k search, tool calls and the pipeline."""

import json
import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from tests.conftest import SMALL, explained, rows
from tidemark.llm import mixing, packing, queries, tool_calls, topk


def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


@given(st.integers(0, 5000))
@settings(max_examples=200, deadline=None)
def test_pieces_are_binary(length):
    cut = packing.pieces(length)
    assert sum(n for _, n in cut) == length and all(n & (n - 1) == 0 for _, n in cut)
    assert [s for s, _ in cut] == [sum(n for _, n in cut[:k]) for k in range(len(cut))]
    assert len([n for _, n in cut if n < 1024]) == bin(length % 1024).count("1")


def test_limit_must_be_a_power_of_two():
    with pytest.raises(ValueError):
        packing.pieces(5, 1000)


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_are_the_tokenizers(text):
    assert packing.encoding().encode_ordinary(text) == tokenizer().encode(text, add_special_tokens=False).ids


def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    of = tokenizer()
    want = {r["doc_id"]: [*of.encode(r["text"] or "", add_special_tokens=False).ids, 0] for r in docs.collect()}
    found = queries.op8_power_of_two_packing(spark, SMALL).collect()
    assert len({r["sequence_id"] for r in found}) == len(found) and {r["offset"] for r in found} == {0}
    held = {}
    for r in found:
        ids = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == packing.ids_crc32(ids) and r["doc_tokens"] == len(want[r["doc_id"]]) and r["length"] == 2 ** r["bucket"] <= 1024
        held[r["doc_id"]] = held.get(r["doc_id"], 0) + r["length"]
    assert held == {d: len(ids) for d, ids in want.items()}
    full = packing.packed(docs)
    assert all(want[r["doc_id"]][r["start"]:r["start"] + r["length"]] == r["ids"] for r in full.collect())
    assert "Exchange" not in explained(full)


def test_packing_edge_cases(spark, folder):
    data = [(1, None, 7), (1, "", 7), (None, "a", 7), (2, "<|endoftext|>", 7), (3, "word " * 200_000, 7)]
    df = spark.createDataFrame(data, "doc_id long, text string, bucket int")
    found = packing.packed(df).collect()
    assert sorted((r["length"], r["ids"]) for r in found if r["doc_id"] == 1) == [(1, [0]), (1, [0])]
    assert 50256 not in [i for r in found if r["doc_id"] == 2 for i in r["ids"]]
    assert sum(r["length"] for r in found if r["doc_id"] == 3) == len(packing.encoding().encode_ordinary("word " * 200_000)) + 1
    assert packing.packed(df.limit(0)).count() == 0
    path = folder("buckets")
    packing.write_buckets(packing.packed(df), path)
    assert spark.read.parquet(path).where("bucket = 10").select(F.size("ids")).distinct().collect() == [(1024,)]


UNMODIFIED = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def unmodified(text):
    return UNMODIFIED.encode(text, add_special_tokens=False).ids


@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext|", "<|", "|>", " ", "  ", "\n", "a", " b", "é", "'s", "12", "😀"]), max_size=12).map("".join))
@settings(max_examples=100, deadline=None)
def test_marked_ids_are_the_unmodified_tokenizers(text):
    assert packing.encoder(marks=True)(text) == unmodified(text)


def test_query_and_pipeline_find_marks(spark, folder):
    texts = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|><|endoftext|> y  ", None]
    path = folder("marks")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{path}/documents.parquet")
    want = {k: [*unmodified(t or ""), 0] for k, t in enumerate(texts)}
    assert want[0] == [64, 50256, 65, 0]
    for r in corpus_pipeline.pack(spark, docs, path).collect():
        assert r["ids"] == want[r["doc_id"]][r["start"]:r["start"] + r["length"]] and r["doc_tokens"] == len(want[r["doc_id"]])
    for r in queries.op8_power_of_two_packing(spark, path).collect():
        assert r["ids_crc32"] == packing.ids_crc32(want[r["doc_id"]][r["start"]:r["start"] + r["length"]])


def mix_by_hand(plan, budget_left):
    """Copies of one source's documents from the order of its blocks and documents."""
    epochs, left = plan
    blocks = {}
    for d in budget_left:
        blocks.setdefault((d["block_order"]), []).append(d)
    out, used = {}, 0
    for _, docs in sorted(blocks.items()):
        total = sum(d["tokens"] for d in docs)
        if left and used + total <= left:
            out |= {d["doc_id"]: epochs + 1 for d in docs}
        elif used >= left:
            out |= {d["doc_id"]: epochs for d in docs}
        else:
            inside = used
            for d in docs:
                inside += d["tokens"]
                out[d["doc_id"]] = epochs + (inside <= left)
        used += total
    return out


def entropy(weights):
    return -sum(w * math.log(w) for w in weights if w)


@pytest.mark.parametrize(("goal", "repeats", "block"), [(0.97, 4.0, 10), (0.97, 1.3, 1000), (0.5, 4.0, 5)])
def test_mixing_against_brute_force(spark, goal, repeats, block):
    data = [(k, " ".join(["w"] * (k % 23)), "big" if k % 5 else f"s{k % 3}") for k in range(600)]
    found = mixing.mixed(spark.createDataFrame(data, "doc_id long, text string, source string"), entropy=goal, repeats=repeats, block=block)
    order = mixing._hash(9, "doc_id")
    found = sorted(found.withColumn("o", order).collect(), key=lambda r: (r["o"], r["doc_id"]))
    tokens = {k: len(t.split()) for k, t, _ in data}
    sums = {}
    for k, _, s in data:
        sums[s] = sums.get(s, 0) + tokens[k]
    total = sum(sums.values())

    def weights(alpha):
        power = {s: (n / total) ** alpha for s, n in sums.items()}
        return {s: p / sum(power.values()) for s, p in power.items()}

    def fits(alpha):
        w = weights(alpha)
        return entropy(w.values()) <= goal * math.log(len(w)) and max(w[s] * total / sums[s] for s in w) <= repeats

    low, high = 0.0, 1.0
    if fits(1.0):
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (low, middle) if fits(middle) else (middle, high)
    alpha = round(high, 6)
    want = weights(alpha)
    assert {r["doc_id"]: r["tokens"] for r in found} == tokens
    assert all(abs(r["weight"] - want[r["source"]]) < 1e-6 for r in found)
    for source, share in sums.items():
        own = [r for r in found if r["source"] == source]
        budget = math.floor(own[0]["weight"] * total)
        epochs = budget // share
        assert {r["doc_id"]: r["copies"] for r in own} == mix_by_hand((epochs, budget - epochs * share), own)
        read = sum(r["copies"] * r["tokens"] for r in own)
        assert budget - max(tokens.values()) * 2 <= read <= budget


def test_mixing_edge_cases(spark):
    schema = "doc_id long, text string, source string, copies int, _doc string"
    df = spark.createDataFrame([(1, "a b", None, 1, "x"), (1, "a b", None, 1, "x"), (2, None, "s", 2, "y"), (None, "", "s", 3, "z"), (3, "c " * 100_000, "t", 4, "w")], schema)
    plan = {r["doc_id"]: (r["tokens"], r["copies"]) for r in mixing.mixed(df).collect()}
    assert plan.keys() == {1, 2, 3, None} and plan[1][0] == 4 and plan[2] == (0, 1) and plan[None] == (0, 1) and plan[3][0] == 100_000
    out = mixing.mix(df)
    assert out.columns == df.columns and out.where("doc_id = 1").count() == 2 * plan[1][1]
    assert mixing.mixed(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).count() == 0
    blank = mixing.mixed(df.where("doc_id = 2"))
    assert [r["copies"] for r in blank.collect()] == [1]


def search_by_hand(vectors, k):
    ints = {i: [math.floor(1024 * x) for x in v] for i, v in vectors if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in sorted(i for i in ints if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=False)), i) for i, v in ints.items() if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return out


def test_tool_query_passes_every_row(spark, folder):
    chats = [(1, 0, "system", "s"), (1, 0, "user", "u"), (1, 1, "assistant", "abc"), (1, 2, "user", "r"), (1, 3, "assistant", None), (1, 4, "user", None), (2, 0, None, None)]
    path = folder("chats")
    spark.createDataFrame(chats, "conv_id long, turn int, role string, text string").write.parquet(f"{path}/conversations.parquet")
    assert queries.tool_messages(spark, path).count() == len(chats)
    got = {(r["call_id"], r["status"], r["result_turn"]) for r in queries.op2_tool_call_linking(spark, path).collect()}
    assert got == {("call-1-1", "linked", 2)}


def run_search(spark, vectors, **options):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    stored = topk.numbered(topk.scaled(df))
    return sorted(rows(topk.top_k(stored, stored.where("id % 100 = 0"), **options)))


def test_top_k_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(5)
    vectors = [(k, [float(x) for x in rng.normal(size=6).round(1)]) for k in range(400)]
    vectors += [(1000, None), (1100, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1200, [float("nan")] * 6), (1300, [float("inf")] + [0.0] * 5), (1400, [0.0] * 6), (1500, [1.0] * 4)]
    vectors += [(2000 + k, vectors[0][1]) for k in range(60)]
    assert run_search(spark, vectors, least=16, query_block=2) == search_by_hand(vectors, 10)
    assert run_search(spark, vectors[:4]) == search_by_hand(vectors[:4], 10)
    assert run_search(spark, [(1000, None)]) == []


def test_threshold_stops_early():
    """With one strong dimension the walk ends long before the lists do, and finds what a full scan finds."""
    rng = np.random.default_rng(2)
    x = rng.integers(-20, 20, (5000, 4))
    x[:, 0] = rng.integers(-10_000, 10_000, 5000)
    order = np.argsort(x, axis=0, kind="stable")
    for query in (np.array([50, 1, -1, 0]), np.array([-50, 0, 0, 2])):
        ids, scores, depth = topk.search(x, np.arange(5000), query, 10, order)
        full = x @ query
        want = np.lexsort((np.arange(5000), -full))[:10]
        assert (ids == want).all() and (scores == full[want]).all() and depth < 500


def test_repeated_vector_ids(spark):
    got = run_search(spark, [(100, [1.0]), (100, [2.0]), (5, [3.0])])
    assert got == [(100, 1, 5, 3 * 1024 * 1024), (100, 1, 5, 6 * 1024 * 1024), (100, 2, 100, 2 * 1024 * 1024), (100, 2, 100, 2 * 1024 * 1024)]


def chat(spark, messages):
    return spark.createDataFrame([(c, t, r, x if x is None or isinstance(x, str) else json.dumps(x)) for c, t, r, x in messages], "conv_id long, turn long, role string, text string")


def call(call_id, name="search", arguments=None, after=None):
    return {"tool_calls": [{"id": call_id, "name": name, "arguments": {"query": "q"} if arguments is None else arguments, "after": after}]}


def linked(spark, messages):
    return {(r["conv_id"], r["call_id"], r["status"]): r for r in tool_calls.link_tool_calls(chat(spark, messages), queries.TOOLS).collect()}


def test_links_and_orphans(spark):
    got = linked(spark, [
        (1, 0, "assistant", call("a")), (1, 1, "tool", {"tool_call_id": "a", "content": 'x "y"\n'}), (1, 2, "assistant", call("b", after="a")),
        (2, 0, "tool", {"tool_call_id": "a", "content": None}), (1, 3, "assistant", "plain text"), (1, 4, "assistant", None), (None, 0, "assistant", call("a")),
        (None, 1, "tool", {"tool_call_id": "a", "content": "n"}), (3, 0, "assistant", call(None)), (1, 5, "tool", {"tool_call_id": "a", "content": "later"}),
        (1, 0, "assistant", call("a")), (1, 6, "assistant", call("a", name="fetch")), (1, 7, "tool", "[]")])
    assert set(got) == {(1, "a", "linked"), (1, "a", "no_result"), (1, "b", "no_result"), (2, "a", "orphan_result"), (None, "a", "linked"), (3, None, "no_id")}
    again = got[1, "a", "no_result"]
    assert (again["name"], again["turn"], again["nth"], again["results"]) == ("fetch", 6, 2, 0)
    first = got[1, "a", "linked"]
    assert first["result_turn"] == 1 and first["results"] == 2 and first["name"] == "search" and first["level"] == 0 and first["waits_for"] is None
    assert first["record"] == '{"arguments":{"query":"q"},"id":"a","name":"search","result":"x \\"y\\"\\n"}'
    assert got[1, "b", "no_result"]["level"] == 1 and got[1, "b", "no_result"]["waits_for"] is True


@pytest.mark.parametrize(("name", "arguments", "errors", "canonical"), [
    ("search", {"query": "q", "limit": 3}, [], '{"limit":3,"query":"q"}'),
    ("search", '{ "query" : "é\\u0041" }', [], '{"query":"éA"}'),
    ("search", {"limit": "3"}, ["missing:query", "type:limit"], '{"limit":"3"}'),
    ("search", {"query": None}, ["type:query"], '{"query":null}'),
    ("fetch", {"url": "u", "options": {"b": {"z": 1, "a": [1, 2]}, "a": 1.5}, "z": 0}, ["unknown:z"], '{"options":{"a":1.5,"b":{"a":[1,2],"z":1}},"url":"u","z":0}'),
    ("calculate", {"values": [], "operation": "sum"}, [], '{"operation":"sum","values":[]}'),
    ("nothing", {}, ["unknown_tool"], "{}"), ("search", "not json", ["malformed"], None), ("search", "[1]", ["malformed"], None), ("search", "", ["malformed"], None),
])
def test_validation_and_canonical_form(spark, name, arguments, errors, canonical):
    [r] = linked(spark, [(1, 0, "assistant", call("a", name, arguments))]).values()
    assert (r["errors"], r["arguments"]) == (errors, canonical)


def test_levels_of_long_chains_forks_and_cycles(spark):
    chain = [(1, k, "assistant", call(f"c{k}", after=f"c{k - 1}" if k else None)) for k in range(70)]
    fork = [(2, 0, "assistant", {"tool_calls": [{"id": "r", "name": "search"}, {"id": "x", "after": "r", "name": "search"}, {"id": "y", "after": "r", "name": "search"}]})]
    odd = [(3, 0, "assistant", call("late", after="early")), (3, 1, "assistant", call("early")), (4, 0, "assistant", call("p", after="q")), (4, 1, "assistant", call("q", after="p")),
           (4, 2, "assistant", call("s", after="s")), (4, 3, "assistant", call("t", after="s")), (5, 0, "assistant", call("u", after="gone"))]
    got = {(c, i): (r["level"], r["waits_for"]) for (c, i, _), r in linked(spark, chain + fork + odd).items()}
    assert all(got[1, f"c{k}"][0] == k for k in range(70))
    assert got[2, "r"] == (0, None) and got[2, "x"] == got[2, "y"] == (1, True) and got[3, "late"] == (1, True) and got[5, "u"] == (0, False)
    assert all(got[4, i] == (None, True) for i in "pqst")
    assert [r["call_id"] for r in tool_calls.topological(tool_calls.link_tool_calls(chat(spark, odd), queries.TOOLS), F.lit(3)).collect()] == ["early", "late"]


def test_ids_that_start_again(spark):
    """Every call is a row; a result belongs to the latest call of its id before it, over any distance."""
    got = tool_calls.link_tool_calls(chat(spark, [
        (1, 0, "assistant", call("a")), (1, 1, "assistant", call("a", "fetch")), (1, 2, "tool", {"tool_call_id": "a", "content": "r1"}), (1, 3, "assistant", call("a")),
        (1, 4, "tool", {"tool_call_id": "a", "content": "r2"}), (1, 5, "tool", {"tool_call_id": "a", "content": "r3"}), (1, 900, "assistant", call("w", after="a")),
        (1, 2000, "assistant", call("a")), (1, 5000, "tool", {"tool_call_id": "a", "content": "far"}), (2, 0, "tool", {"tool_call_id": "b", "content": "early"}),
        (2, 1, "assistant", call("b"))]), queries.TOOLS).collect()
    rows_of = sorted((r["conv_id"], r["call_id"], r["nth"] or 0, r["turn"] or -1, r["name"], r["status"], r["result_turn"], r["results"]) for r in got)
    assert [r[2:] for r in rows_of if r[:2] == (1, "a")] == [(1, -1, "search", "no_result", None, 0), (2, 1, "fetch", "linked", 2, 1), (3, 3, "search", "linked", 4, 2), (4, 2000, "search", "linked", 5000, 1)]
    assert sorted(r[5] for r in rows_of if r[:2] == (2, "b")) == ["no_result", "orphan_result"]


def longest(waits: dict[str, list[str]]) -> dict[str, int | None]:
    """Longest distance from a call that waits for none; None on and behind rings."""
    out: dict[str, int | None] = {}
    for _ in range(len(waits) + 1):
        for k, after in waits.items():
            if all(out.get(a) is not None for a in after):
                out[k] = max((out[a] + 1 for a in after), default=0)
    settled = dict(out)
    return {k: settled.get(k) for k in waits}


@pytest.mark.parametrize("seed", range(3))
def test_levels_of_several_parents(spark, seed):
    """Diamonds, transitive waits, chains between them, and rings, against plain relaxation."""
    import random

    pick = random.Random(seed)
    waits, messages = {}, []
    for k in range(60):
        earlier = [f"c{j}" for j in range(max(0, k - 6), k)]
        after = sorted(pick.sample(earlier, min(len(earlier), pick.choice([0, 1, 1, 1, 2, 3]))))
        if seed == 2 and k in (10, 40):
            after.append(f"c{k + 3}")
        waits[f"c{k}"] = after
        messages.append((1, k, "assistant", call(f"c{k}", after=after if len(after) != 1 else after[0])))
    got = {r["call_id"]: r["level"] for r in tool_calls.link_tool_calls(chat(spark, messages), queries.TOOLS).collect()}
    assert got == longest(waits)
    some = {r["call_id"]: (r["waits_for"], r["level"]) for r in tool_calls.link_tool_calls(chat(spark, [
        (1, 0, "assistant", call("a")), (1, 1, "assistant", call("b", after=["a", "gone"])), (1, 2, "assistant", call("c", after=["a", None, "a"])), (1, 3, "assistant", call("d", after=[])),
        (1, 4, "assistant", call("e", after="[not a list"))]), queries.TOOLS).collect()}
    assert some == {"a": (None, 0), "b": (False, 1), "c": (True, 1), "d": (None, 0), "e": (False, 0)}


def test_tool_calls_of_nothing_and_long_texts(spark):
    assert linked(spark, []) == {}
    [r] = linked(spark, [(1, 0, "assistant", call("a")), (1, 1, "tool", {"tool_call_id": "a", "content": "w " * 200_000})]).values()
    assert len(json.loads(r["record"])["result"]) == 400_000
    with pytest.raises(ValueError):
        tool_calls.Tool("t", {"a b": "string"})
    with pytest.raises(ValueError):
        tool_calls.Tool("t", {"a": "text"})


def test_tool_calls_stay_native(spark):
    plan = explained(tool_calls.link_tool_calls(queries.tool_messages(spark, SMALL), queries.TOOLS))
    assert "Python" not in plan and "Arrow" not in plan


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("n_chars", F.col("n_chars"))
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and re.match("toxicity,exact dedup,MinHash near-dedup,mixing.*,packing", ",".join(names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SMALL)
        assert docs.columns == columns, name
        if name != "mixing sources to target weights":
            assert docs.count() <= before.count() and not docs.exceptAll(before).count(), name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.agg(F.sum("length")).first()[0] > 0 and not last.isEmpty()


def test_pipeline_keeps_clean_documents(spark):
    """Plain, different documents all come through the filtering stages."""
    data = [(k, " ".join(f"word{k}x{j}" for j in range(30)), "en", f"src{k % 3}", 0) for k in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 60


def test_pipeline_on_awkward_rows(spark):
    data = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "a b c d e f", "en", "s", 1), (3, "a b c d e f ", "en", "s", 1), (4, "w " * 50_000, "en", "s", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            empty = stage(spark, empty, SMALL)
            empty.count()


def test_top_k_brings_ids_back_as_they_are(spark):
    """Null ids beside ids that no float holds; null ids come last among equal scores."""
    big = (1 << 60) + 1
    table = spark.createDataFrame([(None, [1.0, 0.0]), (big, [1.0, 0.0]), (big + 1, [0.5, 0.0]), (100, [1.0, 0.0]), (None, [0.25, 0.0])], "vec_id long, embedding array<double>")
    stored = topk.numbered(topk.scaled(table))
    got = topk.top_k(stored, stored.where("id = 100 or id is null"), k=3).collect()
    of = lambda i: sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == i)
    assert of(100) == [(1, big, 1 << 20), (2, None, 1 << 20), (3, big + 1, 1 << 19)]
    mine = [(r["rank"], r["vec_id"]) for r in got if r["query_id"] is None]
    assert sorted(mine, key=repr) == sorted([(1, 100), (2, big), (3, big + 1), (1, 100), (2, big), (3, None)], key=repr)
    assert {r["vec_id"] for r in got} <= {None, big, big + 1, 100}


def test_the_mix_is_written_in_its_order(spark):
    """Copies lie an epoch apart, every stretch has all sources, blocks stay together, and columns of any name keep their values."""
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 2700, "large").when(F.col("id") < 2900, "middle").otherwise("small").alias("source"),
        F.lit("some words of a text").alias("text"), (F.col("id") * 2).alias("_copies"), F.col("id").cast("string").alias("_nth"), F.lit(1.5).alias("_place"))
    got = mixing.mix(docs, block=50).collect()
    plan = {r["doc_id"]: r["copies"] for r in mixing.mixed(docs, block=50).collect()}
    assert got[0].asDict().keys() == set(docs.columns) and all(r["_copies"] == 2 * r["doc_id"] and r["_nth"] == str(r["doc_id"]) and r["_place"] == 1.5 for r in got)
    places = {}
    for n, r in enumerate(got):
        places.setdefault(r["doc_id"], []).append(n)
    assert {d: len(p) for d, p in places.items()} == {d: c for d, c in plan.items() if c}
    repeated = [p for p in places.values() if len(p) >= 2]
    assert repeated and sum(b - a > 10 for p in repeated for a, b in zip(p, p[1:], strict=False)) > 0.95 * sum(len(p) - 1 for p in repeated)
    share = sum(r["source"] == "small" for r in got) / len(got)
    tenth = len(got) // 10
    parts = [sum(r["source"] == "small" for r in got[k * tenth:(k + 1) * tenth]) / tenth for k in range(10)]
    assert max(parts) < 4 * share and sum(p > 0 for p in parts) >= 6
    several = {d: p for d, p in places.items() if len(p) > 1}
    assert sorted(several, key=lambda d: several[d][0]) != sorted(several, key=lambda d: several[d][1])  # another order in each epoch
