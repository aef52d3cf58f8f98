"""Manifest, chat format and prefix trie against plain readings of their rules."""

import json
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.llm import cases
from tradewind.llm import chat_format, merkle, prefix_trie, queries
from tradewind.llm.chat_format import INST, LAYOUTS, Layout, Registry

TURNS = "conv_id bigint, turn bigint, role string, text string"


# manifest

def manifest(docs, fanout):
    found = merkle.document_manifest(docs, F.col("doc_id") % 3 == 0, fanout)
    return found.select("*", merkle.proof_digest(F.col("path")).alias("proof")).collect()


def check_manifest(rows, got, fanout):
    want = cases.merkle_rows([(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in rows], fanout)
    seen = sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof) for r in got), key=repr)
    assert seen == sorted(((i, leaf, sub, root, cases.sha("".join("".join(a + b) for a, b in path))) for i, leaf, sub, root, path in want), key=repr)
    for r in got:
        touched = r.doc_id is not None and r.doc_id % 3 == 0 and next(x["n_chars"] for x in rows if x["doc_id"] == r.doc_id) is not None
        assert r.verified == (r.folded_root == r.root) == (not touched)


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest_of_awkward_rows(spark, fanout):
    docs = cases.awkward(spark)
    check_manifest([r.asDict() for r in docs.collect()], manifest(cases.with_clashes(docs).withColumns({n: F.lit(1) for n in ("idx", "group", "node", "before", "path", "root")}), fanout), fanout)


@pytest.mark.parametrize("sizes", [[1], [2], [3, 1], [8, 7, 9, 1, 33]])
def test_manifest_of_groups_of_any_size(spark, sizes):
    rows = [(100 * g + k, f"text {k}", f"l{g}", "s", k) for g, n in enumerate(sizes) for k in range(n)]
    random.Random(3).shuffle(rows)
    docs = spark.createDataFrame(rows, cases.SCHEMA).repartition(4)
    check_manifest([r.asDict() for r in docs.collect()], manifest(docs, 2), 2)


def test_manifest_of_nothing_and_of_repeated_rows(spark):
    assert manifest(cases.empty(spark), 2) == []
    same = manifest(spark.createDataFrame([(1, "a", "en", "s", 1)] * 5, cases.SCHEMA), 2)
    assert len({r.leaf for r in same}) == 1 and len({r.root for r in same}) == 1 and len(same) == 5 and all(r.verified for r in same)


def test_manifest_sees_any_change(spark):
    rows = [(k, f"text {k}", "en" if k % 3 else None, "s", k) for k in range(20)]
    roots = {manifest(spark.createDataFrame(x, cases.SCHEMA), 2)[0].root for x in (rows, rows[:-1], [*rows[:-1], (19, "text x", "en", "s", 19)])}
    assert len(roots) == 3
    with pytest.raises(ValueError):
        merkle.build_manifest(cases.empty(spark).withColumn("node", F.lit("")), "lang", ["doc_id"], 1)


def test_lowest_level_is_joined_by_index(spark):
    docs = spark.createDataFrame([(k, "t", "en", "s", 1) for k in range(100)], cases.SCHEMA)
    forest, crown = merkle.build_manifest(docs.select("doc_id", "lang", merkle.leaf_digest().alias("node")), "lang", ["doc_id"])
    assert [level.count() for level in forest.levels] == [100, 50, 25, 13, 7, 4, 2, 1] and len(crown.levels) == 1


# chat format

RECORDS = {
    "prompt_completion": {"prompt": "p", "completion": "c", "title": "not a turn"},
    "prompt_response": {"system": "s", "prompt": "p", "response": "c"},
    "question_answer": {"question": "p", "answer": "c"},
    "instruction": {"instruction": "s", "input": "p", "output": "c"},
    "instruction_only": {"instruction": "p", "output": "c"},
    "messages": {"messages": [{"role": "user", "content": "p"}, {"role": "assistant", "content": "c", "weight": 1}], "id": {"date": 3}},
    "data_messages": {"data": {"messages": [{"role": "user", "content": "p"}, {"role": "assistant", "content": "c"}]}},
    "from_value": {"system": "s", "conversations": [{"from": "human", "value": "p"}, {"from": "gpt", "value": "c"}]},
}


def turns(spark, records):
    rows = spark.createDataFrame([(k, r if r is None or isinstance(r, str) else json.dumps(r)) for k, r in enumerate(records)], "conv_id bigint, record string")
    found = chat_format.canonical_turns(rows).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r.conv_id, r.place or 0)):
        out.setdefault(r.conv_id, []).append((r.layout, r.role, r.text))
    return out


def test_layouts_are_told_apart_by_their_fields(spark):
    found = turns(spark, RECORDS.values())
    for k, (name, record) in enumerate(RECORDS.items()):
        said = [("user", "p"), ("assistant", "c")]
        says_system = "system" in record or name == "instruction"
        assert found[k] == [(name, *t) for t in ([("system", "s")] if says_system else []) + said]


def test_records_that_no_layout_knows(spark):
    found = turns(spark, ["{broken", None, "", [1, 2], {"prompt": "p"}, {"messages": []}, {"messages": "x"}, {"prompt": None, "completion": {"a": 1}},
                          {"question": "a\ud800b", "answer": None}, {"messages": [{"role": "user", "content": "p"}, "loose", {"role": None, "content": 5}]}])
    assert all(found[k] == [(None, None, None)] for k in range(7))
    assert found[7] == [("prompt_completion", "user", ""), ("prompt_completion", "assistant", '{"a": 1}')]
    assert found[8] == [("question_answer", "user", "a?b"), ("question_answer", "assistant", "")]
    assert found[9] == [("messages", "user", "p"), ("messages", "", "loose"), ("messages", "", "5")]


def test_layouts_with_equal_fields_are_refused():
    with pytest.raises(ValueError):
        Registry([*LAYOUTS, Layout("again", fixed=(("user", "question"), ("assistant", "answer")))])
    assert chat_format.field_paths({"a": [{"b": [1]}, {"c": {"d": 2}}]}) == {"a", "a[].b", "a[].c", "a[].c.d"}


PIECES = st.lists(st.sampled_from([*INST.controls(), "<", "s", ">", "/", "[", "]", "\\", "\n", " ", "é", "x", "漢", "\x00"]), max_size=8).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), PIECES)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ROLE, PIECES), max_size=5))
def test_template_is_reversible(said):
    formatted = "".join("".join(INST.turn(*t)) for t in said)
    parsed = INST.parse(formatted)
    assert [t[:2] for t in parsed] == said
    assert [chat_format.unescape(formatted[a:b]) for _, _, a, b in parsed] == [t for _, t in said]
    for _, text in said:
        assert not any(c in INST.escape(text) for c in INST.controls())


def formatted(spark, rows, path, part=chat_format.PART):
    records = chat_format.as_records(spark.createDataFrame(rows, TURNS), ["turn", "role", "text"])
    chat_format.write_formatted(chat_format.canonical_turns(records), path, part=part)
    return chat_format.read_formatted(spark, path)


def expected(rows):
    own = {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    learned = {c: "".join(t for r, t in said if r == "assistant") for c, said in own.items()}
    return {
        c: (len(said), cases.sha("".join(f"{r}\n{t}\n" for r, t in said)), len(learned[c]), cases.sha(learned[c]), sum(len("".join(INST.turn(*t))) for t in said))
        for c, said in own.items()
    }


CHAT = [
    (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (2, 1, "assistant", "b\\"), (2, None, "system", "first"),
    (2, 0, "user", None), (3, 0, None, "no role"), (3, 0, None, "no role"), (None, 0, "user", "no conversation"), (None, 1, "assistant", ""),
    (4, 2, "tool", "x" * 5000), (4, 1, "assistant", "é漢" * 2000), (5, 0, "a]b\\", "[ROLE x] "), (-6, 0, "assistant", ""),
]


@pytest.mark.parametrize("part", [1, 3000, chat_format.PART])
def test_what_is_read_back_is_what_was_said(spark, tmp_path, part):
    rows = CHAT + [(7, k, ("user", "assistant")[k % 2], f"turn {k}" * 20) for k in range(300)]
    out = formatted(spark, rows, str(tmp_path / "f"), part)
    got = {r.conv_id: tuple(r)[1:] for r in chat_format.read_back(out).collect()}
    assert got == expected(rows)
    assert (out.where("NOT whole").count() > 0) == (part < chat_format.PART)
    back = chat_format.parsed_turns(out).orderBy("part", "place").collect()
    assert [(r.role, r.text) for r in back if r.conv_id == 7] == [r[2:] for r in rows if r[0] == 7]


def test_formatting_nothing(spark, tmp_path):
    out = formatted(spark, [], str(tmp_path / "f"))
    assert chat_format.read_back(out).count() == 0 and chat_format.parsed_turns(out).count() == 0


# prefix trie

def nodes(spark, rows, block=prefix_trie.BLOCK):
    df = spark.createDataFrame(rows, TURNS).withColumns({n: F.col("text") for n in ("depth", "pos", "content", "block", "own")})
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    rebuilt, convs = prefix_trie.replace_heads(prefix_trie.numbered_turns(df), F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(100)), heads, 5)
    got = prefix_trie.trie_nodes(rebuilt, convs, block).collect()
    found = {(r.conv_id, r.depth): tuple(r)[2:] for r in got}
    assert len(found) == len(got)
    return found


def wanted(rows):
    rebuilt = cases.rebuilt_turns([r for r in rows if r[0] is not None])
    return cases.trie(rebuilt, sorted(rebuilt))


@pytest.mark.parametrize("block", [1, 2, 4, 7])
def test_trie_of_conversations_that_share_much(spark, block):
    rng = random.Random(block)
    rows = []
    for c in [*range(0, 40), *range(195, 230), *range(1000, 1010)]:
        said = [rng.choice("abc") for _ in range(rng.randrange(1, 14))] if c % 4 else list("abcabcabcabcabc")[:rng.randrange(1, 16)]
        rows += [(c, t, ("user", "assistant")[t % 2], x * (1 + t % 3)) for t, x in enumerate(said)]
    rng.shuffle(rows)
    assert nodes(spark, rows, block) == wanted(rows)


def test_trie_of_awkward_rows(spark):
    rows = [
        (0, None, "user", "hello"), (0, 1, None, None), (0, 2, "user", "same"), (3, 0, "", ""), (5, 0, "user", "only"), (101, 0, "user", "x"),
        (None, 0, "user", "nobody"), (-5, 0, "user", "negative"), (-5, 1, "assistant", "twice"), (-100, 0, "user", "base"), (7, 0, "user", "é漢\x00"), (7, 1, "user", "y" * 9000),
        *[(c, t, "user", "copy") for c in range(8, 30) for t in range(4)],
    ]
    assert nodes(spark, rows) == wanted(rows)
    assert nodes(spark, [(None, 0, "user", "nobody")]) == {} and nodes(spark, []) == {}


def test_trie_where_equal_rows_are_turns(spark):
    rows = [(0, 0, "user", "again"), (0, 0, "user", "again"), (1, 0, "user", "again")]
    found = nodes(spark, rows)
    assert found == wanted(rows) and max(d for _, d in found) >= 2


def test_one_long_conversation_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 50)
    rows = [(0, t, "user", f"t{t % 7}") for t in range(600)] + [(c, t, "user", f"t{t % 7}") for c in range(1, 150) for t in range(6)]
    assert nodes(spark, rows) == wanted(rows)


def test_same_words_under_other_roles_are_other_turns(spark):
    rows = [(0, 0, "user", "ab"), (300, 0, "usera", "b"), (600, 0, None, "userab"), (900, 0, "user", "ab")]
    found = nodes(spark, rows)
    assert found == wanted(rows) and found[0, 0][2] == 3
    assert queries.ORACLE_SQL["op13_prefix_trie"].count("conversations") == 1
