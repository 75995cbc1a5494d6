from __future__ import annotations

import json
import random
import re

from salescope.llm.chat_format import format_chats, link_calls

SCHEMAS = {
    "add": {
        "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "number"}, "mode": {"type": "string", "enum": ["x", "y"]}},
        "required": ["a", "b"],
        "additionalProperties": False,
    },
    "free": {"properties": {"s": {"type": "string", "maxLength": 3}, "o": {"type": "object"}, "l": {"type": "array"}, "t": {"type": "boolean"}}},
}
CALLS = "conv_id long, call_id string, turn long, pos int, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id long, call_id string, turn long, content string"


def run(spark, calls, results):
    out = link_calls(spark.createDataFrame(calls, CALLS).repartition(3), spark.createDataFrame(results, RESULTS), SCHEMAS)
    return sorted(out.collect(), key=lambda r: repr((r.conv_id, r.call_id, r.turn, r.pos)))


def test_linking_order_and_status(spark):
    calls = [
        (1, "c", 3, 0, "add", '{"b":2.5, "a":1}', ["a", "b"]),
        (1, "a", 1, 0, "add", '{"a":1,"b":1}', []),
        (1, "b", 1, 1, "add", '{"a":1,"b":1}', ["a"]),
        (1, "b", 5, 0, "add", '{"a":9,"b":9}', []),
        (1, "d", 6, 0, "free", "{}", ["gone", "a"]),
        (2, "x", 1, 0, "free", "{}", ["y"]),
        (2, "y", 1, 1, "free", "{}", ["x"]),
        (2, "z", 2, 0, "free", "{}", ["y"]),
        (2, "self", 2, 1, "free", "{}", ["self"]),
        (3, "a", 1, 0, "free", "{}", []),
        (3, "a", 1, 0, "free", "{}", []),
        (None, "n", 1, 0, "free", "{}", []),
        (4, None, 1, 0, "free", "{}", []),
    ]
    results = [(1, "a", 2, '"ok"'), (1, "a", 4, '"late"'), (1, "b", 2, '{"z":1,"y":[1, 2]}'), (9, "q", 1, "1"), (2, "x", 3, "null"), (None, "n", 1, "1")]
    rows = run(spark, calls, results)
    by = {(r.conv_id, r.call_id, r.turn, r.pos): r for r in rows}
    assert [by[1, k, t, p].level for k, t, p in (("a", 1, 0), ("b", 1, 1), ("c", 3, 0), ("d", 6, 0))] == [0, 1, 2, 1]
    assert by[1, "a", 1, 0].status == "linked" and by[1, "a", 1, 0].n_results == 2
    assert json.loads(by[1, "a", 1, 0].json)["result"] == "ok"
    assert by[1, "b", 5, 0].status == "repeated" and by[1, "b", 5, 0].n_results == 0
    assert by[1, "c", 3, 0].status == "unanswered"
    assert by[1, "d", 6, 0].missing == ["gone"]
    assert {by[2, k, t, p].status for k, t, p in (("x", 1, 0), ("y", 1, 1), ("z", 2, 0), ("self", 2, 1))} == {"cyclic"}
    assert by[3, "a", 1, 0].copies == 2
    assert [(r.conv_id, r.status, r.copies) for r in rows if r.turn is None] == [(9, "orphan", 0), (None, "orphan", 0)]
    assert len(rows) == 14
    line = by[1, "b", 1, 1].json
    assert line == '{"arguments":{"a":1,"b":1},"id":"b","level":1,"name":"add","result":{"y":[1,2],"z":1},"status":"linked"}'


def test_arguments_against_schemas(spark):
    cases = {
        '{"a":1,"b":2.5}': [],
        '{"b":2,"a":"1"}': ["a: not integer"],
        '{"a":-1,"b":1,"mode":"z"}': ["a: under minimum", "mode: not in enum"],
        '{"b":null}': ["a: missing", "b: not number"],
        '{"a":1,"b":1,"c":2,"d":3}': ["c: unknown", "d: unknown"],
        "[1]": ["arguments: not an object"],
        "not json": ["arguments: not an object"],
        '{"a":1,"a":2,"b":1}': ["arguments: not an object"],
        None: ["arguments: not an object"],
    }
    calls = [(1, str(i), i, 0, "add", a, []) for i, a in enumerate(cases)]
    calls += [(1, "f", 50, 0, "free", '{"s":"long","o":[],"l":{},"t":1}', []), (1, "u", 51, 0, "nope", "{}", [])]
    got = {r.call_id: r.errors for r in run(spark, calls, [])}
    assert [got[str(i)] for i in range(len(cases))] == list(cases.values())
    assert got["f"] == ["l: not array", "o: not object", "s: too long", "t: not boolean"]
    assert got["u"] == ["unknown tool nope"]


def test_messages(spark):
    call = {"tool_calls": [{"id": "k", "name": "reply", "arguments": {"words": 3, "prompt": "p"}}, {"id": "m", "name": "reply", "arguments": {}, "depends_on": ["k"]}]}
    rows = [
        (1, 0, "system", 'Be "brief" é\n'),
        (1, 1, "user", "one two three"),
        (1, 2, "assistant", "an answer"),
        (1, 3, "user", None),
        (2, 0, "user", "hi there"),
        (2, 1, "assistant", json.dumps(call)),
        (2, 2, "tool", '{"tool_call_id":"k","content":{"b":1,"a":"é"}}'),
        (2, 3, "assistant", "{not json"),
        (2, 3, "assistant", "{not json"),
        (None, 0, "user", "long " * 20_000),
    ]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, level int")
    out = {(r.conv_id, r.call_id): r for r in format_chats(df).collect()}
    assert out[1, "turn-1"].status == "linked" and json.loads(out[1, "turn-1"].json)["result"] == "an answer"
    assert json.loads(out[1, "turn-0"].json)["arguments"] == {"instruction": 'Be "brief" é\n'}
    assert out[1, "turn-3"].level == 1 and out[1, "turn-3"].errors == ["prompt: too short", "words: under minimum"]
    assert out[2, "k"].status == "linked" and json.loads(out[2, "k"].json)["result"] == {"a": "é", "b": 1}
    assert out[2, "m"].level == 1 and out[2, "m"].errors == ["prompt: missing", "words: missing"]
    assert out[2, "turn-2"].status == "orphan" and out[2, "turn-2"].n_results == 2
    assert out[None, "turn-0"].errors == ["prompt: too long"]
    for r in out.values():
        assert r.json == json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert format_chats(df.limit(0)).count() == 0


def test_word_count_matches_plain_split(spark):
    texts = ["a  b\tc\n", " x", "", "é ü"]
    df = spark.createDataFrame([(i, 0, "user", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: json.loads(r.json)["arguments"]["words"] for r in format_chats(df).collect()}
    assert got == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in enumerate(texts)}


def test_no_message_is_missing(spark):
    call = {"id": "k", "name": "reply", "arguments": {}}
    rows = [
        (1, 0, "user", "asked"),
        (1, 1, "assistant", json.dumps({"content": "beside", "tool_calls": [call]})),
        (1, 2, "tool", "plain result"),
        (1, 3, None, "no role"),
        (1, 4, "critic", '{"tool_call_id":"k","content":1}'),
        (1, 4, "critic", '{"tool_call_id":"k","content":1}'),
        (2, 0, "user", '{"tool_call_id":"x","content":"c"}'),
        (2, 1, "assistant", '{"tool_calls":[],"content":[1,"a"]}'),
        (2, 2, "user", '{"tool_calls":[]}'),
        (2, 3, "assistant", json.dumps({"content": None, "tool_calls": [call]})),
        (2, 4, None, None),
        (2, 5, None, json.dumps({"content": "said", "tool_calls": [{**call, "id": "l"}]})),
        (2, 6, "tool", json.dumps({"content": {"b": 1}})),
        (2, 7, "tool", '{"tool_call_id":"l","content":"done"}'),
    ]
    out = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)).collect()
    loose = {(r.conv_id, r.turn): r for r in out if r.status == "unlinked"}
    by = {(r.conv_id, r.call_id): r for r in out if r.status != "unlinked"}
    assert len(loose) + len(by) == len(out)
    text = {k: (json.loads(r.json)["role"], json.loads(r.json)["result"], r.copies) for k, r in loose.items()}
    assert text == {
        (1, 2): ("tool", "plain result", 1),
        (1, 3): (None, "no role", 1),
        (1, 4): ("critic", rows[4][3], 2),
        (2, 4): (None, "", 1),
        (2, 5): (None, "said", 1),
        (2, 6): ("tool", '{"content": {"b": 1}}', 1),
    }
    status = {k: (r.status, json.loads(r.json)["result"]) for k, r in by.items()}
    assert status == {
        (1, "turn-0"): ("linked", "beside"),
        (1, "k"): ("unanswered", None),
        (2, "turn-0"): ("linked", [1, "a"]),
        (2, "turn-2"): ("unanswered", None),
        (2, "k"): ("unanswered", None),
        (2, "l"): ("linked", "done"),
    }
    assert json.loads(by[2, "turn-0"].json)["arguments"]["prompt"] == rows[6][3]
    assert json.loads(by[2, "turn-2"].json)["arguments"]["prompt"] == rows[8][3]
    for r in loose.values():
        assert r.json == json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def plain_links(calls, results):
    """{(conv_id, call_id, turn, pos, name): (status, level, missing, n_results, copies)}, by plain Python."""
    heads, needs, told = {}, {}, {}
    for c in calls:
        key = c[:2]
        if None not in key:
            heads[key] = min(heads.get(key, c[2:6]), c[2:6])
            needs.setdefault(key, set()).update((key[0], d) for d in c[6])
    for r in results:
        told.setdefault(r[:2], []).append(r)

    def level(key, above=()):
        if key in above:
            return None
        below = [level(n, (*above, key)) for n in needs[key] if n in heads]
        return None if None in below else 1 + max(below, default=-1)

    levels = {k: level(k) for k in heads}
    out = {}
    for c in calls:
        key, at = c[:2], c[2:6]
        if None in key:
            found = ("unanswered", None, (), 0)
        else:
            status = "repeated" if at != heads[key] else "cyclic" if levels[key] is None else "linked" if key in told else "unanswered"
            gone = {d for o in calls if o[:4] == c[:4] for d in o[6] if (key[0], d) not in heads}
            found = (status, levels[key], tuple(sorted(gone)), len(told.get(key, ())) if at == heads[key] else 0)
        out[(*c[:5], *c[6])] = (*found, out.get((*c[:5], *c[6]), (0,) * 5)[4] + 1)
    return out, {k: len(v) for k, v in told.items() if k not in heads}


def test_equals_plain_python(spark):
    draw = random.Random(7)
    calls, results = [], []
    for conv in range(40):
        n = draw.randrange(1, 14)
        names = [f"c{i}" for i in range(n)]
        for i, name in enumerate(names):
            few = draw.choice([0, 1, 1, 1, 2, 3])
            pool = names[:i] + ["gone"] if draw.random() < 0.9 else names
            deps = sorted(set(draw.choices(pool, k=few)))
            calls.append((conv, name, i, 0, "free", "{}", deps))
            if draw.random() < 0.1:
                calls.append((conv, name, i + 20, 0, "free", "{}", []))
            results += [(conv, name, i + 1, "1")] * draw.choice([0, 1, 1, 2])
        results += [(conv, "stray", 3, "1")] * draw.randrange(2)
    calls += [(99, f"d{i}", i, 0, "free", "{}", [f"d{i - 1}"] if i else []) for i in range(70)]  # a long chain
    calls += [(None, "n", i, 0, "free", "{}", []) for i in range(300)] + [(5, None, i, 0, "free", "{}", []) for i in range(300)]
    calls += [(98, "hot", i, 0, "free", "{}", []) for i in range(400)]
    results += [(98, "hot", i, "2") for i in range(50)]
    links, orphans = plain_links(calls, results)
    rows = run(spark, calls, results)
    deps = {c[:5]: tuple(c[6]) for c in calls}
    ours = {}
    for r in rows:
        if r.status != "orphan":
            key = (r.conv_id, r.call_id, r.turn, r.pos, r.name)
            ours[key + deps[key]] = (r.status, r.level, tuple(r.missing), r.n_results, r.copies)
    assert ours == links
    assert {(r.conv_id, r.call_id): r.n_results for r in rows if r.status == "orphan"} == orphans


def test_an_identifier_like_a_turn_is_another(spark):
    call = {"tool_calls": [{"id": "turn-0", "name": "reply", "arguments": {"prompt": "x", "words": 2}}]}
    rows = [(1, 0, "user", "asked first"), (1, 1, "assistant", json.dumps(call)), (1, 2, "tool", '{"tool_call_id":"turn-0","content":"real"}')]
    out = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r.turn, r.status, json.loads(r.json)["result"]) for r in out) == [(0, "unanswered", None), (1, "linked", "real")]


def test_plan_and_jobs_do_not_grow_with_the_conversation(spark):
    def jobs(n):
        calls = [(1, f"d{i}", i, 0, "free", "{}", [f"d{i - 1}"] if i else []) for i in range(n)]
        group = f"chat-{n}"
        spark.sparkContext.setJobGroup(group, group)
        levels = {r.call_id: r.level for r in run(spark, calls, [])}
        assert levels == {f"d{i}": i for i in range(n)}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(300) < 2 * jobs(20)
