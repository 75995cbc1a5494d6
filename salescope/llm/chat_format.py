"""Chat formatting: tool calls linked to their results, ordered, validated and
written as canonical JSON.  DataFrame operations only.

``tool_traffic`` reads calls and results out of messages, ``link_calls`` joins
them by identifier, orders them topologically by their dependencies, checks
the arguments against the tools' schemas and serialises every call as one line
of canonical JSON (sorted keys, no blanks, plain characters).  ``unlinked``
gives the messages that are neither, so that none is missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.store import Stack, materialise

#: A call's name: plain turns (kind 1) have a name space of their own.
_KEY = ["conv_id", "kind", "call_id"]

#: Schemas of the calls that plain turns stand for.
TURN_SCHEMAS = {
    "configure": {
        "properties": {"instruction": {"type": "string", "minLength": 1, "maxLength": 4000}},
        "required": ["instruction"],
        "additionalProperties": False,
    },
    "reply": {
        "properties": {"prompt": {"type": "string", "minLength": 1, "maxLength": 4000}, "words": {"type": "integer", "minimum": 2}},
        "required": ["prompt", "words"],
        "additionalProperties": False,
    },
}


def _text(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def _read(messages: DataFrame) -> DataFrame:
    """Messages with ``listed`` (their tool calls, null if none), ``answers``
    (the call that a message of role ``tool`` answers) with ``reply`` as JSON,
    and ``said`` with ``told`` as JSON (the text besides calls and answers,
    null if none).  Written once, as calls, results and the rest read it."""
    rows = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("doc", F.when(F.col("text").startswith("{"), F.try_parse_json("text")))
    listed = F.try_variant_get("doc", "$.tool_calls", "array<variant>")
    content = F.try_variant_get("doc", "$.content", "variant")
    kind = F.schema_of_variant("content")
    rows = rows.withColumns(
        {
            "has_list": listed.isNotNull(),
            "listed": F.when(F.size(listed) > 0, listed),
            "answers": F.when(F.col("role") == "tool", _text(F.col("doc"), "$.tool_call_id")),
            "content": content,
        }
    )
    rows = rows.withColumn("content", F.when(kind != "VOID", F.col("content")))
    written = F.when(kind == "STRING", F.try_variant_get("content", "$", "string")).otherwise(F.to_json("content"))
    # an empty content beside calls says nothing
    said = (
        F.when(F.col("answers").isNotNull(), F.lit(None))
        .when(F.col("listed").isNotNull(), F.when(written != "", written))
        .when(F.col("has_list"), F.coalesce(written, F.col("text")))
        .otherwise(F.col("text"))
    )
    rows = rows.withColumn("said", said)
    quoted = F.to_json(F.to_variant_object(F.array("said")))
    told = F.when(F.col("has_list") & F.col("content").isNotNull(), F.to_json("content"))
    told = F.when(F.col("said").isNotNull(), F.coalesce(told, F.substring(quoted, F.lit(2), F.length(quoted) - 2)))
    reply = F.when(F.col("answers").isNotNull(), F.to_json("content"))
    return materialise(rows.select("conv_id", "turn", "role", "listed", "answers", reply.alias("reply"), "said", told.alias("told")), "messages")


def tool_traffic(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls ``(conv_id, kind, call_id, turn, pos, name, arguments,
    depends_on)`` and results ``(conv_id, kind, call_id, turn, content)`` of
    messages (conv_id, turn, role, text).

    A message that is a JSON object with ``tool_calls`` (id, name, arguments,
    depends_on) makes those calls; one of role ``tool`` with ``tool_call_id``
    and ``content`` is a result (kind 0).  Plain turns stand for calls too: a
    system turn for ``configure``, a user turn for ``reply`` that depends on the
    user's turn before, and an assistant turn is the result for the turn before
    it; their identifiers are ``turn-<turn>``, of kind 1, so that an identifier
    that looks like one is another.  A null text counts as empty.

    The ``content`` beside ``tool_calls`` is a plain turn of its role, besides
    the calls; a message with an empty list is one too (without a content, its
    whole text).  ``tool_call_id`` means nothing in other roles than ``tool``.
    What is left over is in :func:`unlinked`.
    """
    return _traffic(_read(messages))


def _traffic(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    call = F.col("call")
    explicit = rows.where("listed is not null").select("conv_id", "turn", F.posexplode("listed").alias("pos", "call"))
    explicit = explicit.select(
        "conv_id",
        F.lit(0).alias("kind"),
        _text(call, "$.id").alias("call_id"),
        "turn",
        "pos",
        _text(call, "$.name").alias("name"),
        F.to_json(F.try_variant_get(call, "$.arguments", "variant")).alias("arguments"),
        F.coalesce(F.try_variant_get(call, "$.depends_on", "array<string>"), F.array().cast("array<string>")).alias("depends_on"),
    )
    plain = rows.where("said is not null").withColumn("text", F.col("said"))
    name = lambda t: F.concat(F.lit("turn-"), t.cast("string"))
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    asked = F.col("role") == "user"
    turns = plain.where("role in ('user', 'system')").select(
        "conv_id",
        F.lit(1).alias("kind"),
        name(F.col("turn")).alias("call_id"),
        "turn",
        F.lit(0).alias("pos"),
        F.when(asked, F.lit("reply")).otherwise(F.lit("configure")).alias("name"),
        F.when(asked, F.to_json(F.struct(F.col("text").alias("prompt"), words.alias("words"))))
        .otherwise(F.to_json(F.struct(F.col("text").alias("instruction"))))
        .alias("arguments"),
        F.when(asked & (F.col("turn") >= 2), F.array(name(F.col("turn") - 2))).otherwise(F.array().cast("array<string>")).alias("depends_on"),
    )
    told = rows.where("answers is not null").select("conv_id", F.lit(0).alias("kind"), F.col("answers").alias("call_id"), "turn", F.col("reply").alias("content"))
    said = plain.where("role = 'assistant'").select("conv_id", F.lit(1).alias("kind"), name(F.col("turn") - 1).alias("call_id"), "turn", F.col("told").alias("content"))
    return explicit.unionByName(turns), told.unionByName(said)


def unlinked(messages: DataFrame) -> DataFrame:
    """The messages that neither call nor answer, as rows of
    :func:`link_calls`: those of a role other than user, system and assistant
    (null too), among them the plain texts of role ``tool``.  Their status is
    ``unlinked``, their text is the ``result`` of the line, which names the
    ``role``; equal ones are counted in ``copies``."""
    return _loose(_read(messages))


def _loose(rows: DataFrame) -> DataFrame:
    plain = rows.where("said is not null and coalesce(role not in ('user', 'system', 'assistant'), true)")
    plain = plain.groupBy("conv_id", "turn", "role", "told").agg(F.count(F.lit(1)).alias("copies"))
    none, no = F.lit(None), F.array().cast("array<string>")
    line = F.struct(
        none.cast("string").alias("arguments"),
        none.cast("string").alias("id"),
        none.cast("int").alias("level"),
        none.cast("string").alias("name"),
        F.try_parse_json("told").alias("result"),
        F.col("role"),
        F.lit("unlinked").alias("status"),
    )
    return plain.select(
        "conv_id",
        none.cast("string").alias("call_id"),
        "turn",
        none.cast("int").alias("pos"),
        none.cast("int").alias("level"),
        none.cast("string").alias("name"),
        F.lit("unlinked").alias("status"),
        no.alias("errors"),
        no.alias("missing"),
        "copies",
        F.lit(0).cast("long").alias("n_results"),
        F.to_json(line, {"ignoreNullFields": "false"}).alias("json"),
    )


def _type_is(found: Column, wanted: str) -> Column:
    return {
        "string": found == "STRING",
        "integer": found == "BIGINT",
        "number": (found == "BIGINT") | (found == "DOUBLE") | found.startswith("DECIMAL"),
        "boolean": found == "BOOLEAN",
        "array": found.startswith("ARRAY"),
        "object": found.startswith("OBJECT"),
        "null": found == "VOID",
    }[wanted]


def _errors(name: Column, source: Column, value: Column, schemas: dict[str, dict]) -> Column:
    """Sorted messages about the arguments of a call.  Of JSON schema: type,
    required, additionalProperties, enum, minimum, maximum, minLength and
    maxLength of the outer properties."""
    none = F.lit(None).cast("string")
    whole = F.schema_of_variant(value).startswith("OBJECT")
    out = F.array(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit("null"))))
    for tool, schema in schemas.items():
        found: list[Column] = []
        fields = schema.get("properties", {})
        for f in sorted({*fields, *schema.get("required", [])}):
            rule = fields.get(f, {})
            at = F.try_variant_get(value, f"$['{f}']", "variant")
            there = at.isNotNull()
            if f in schema.get("required", []):
                found.append(F.when(~there, F.lit(f"{f}: missing")).otherwise(none))
            if "type" in rule:
                found.append(F.when(there & ~_type_is(F.schema_of_variant(at), rule["type"]), F.lit(f"{f}: not {rule['type']}")).otherwise(none))
            text, number = F.try_variant_get(value, f"$['{f}']", "string"), F.try_variant_get(value, f"$['{f}']", "double")
            checks = []
            if "enum" in rule:
                checks.append((~text.isin([str(x) for x in rule["enum"]]), "not in enum"))
            if "minimum" in rule:
                checks.append((number < rule["minimum"], "under minimum"))
            if "maximum" in rule:
                checks.append((number > rule["maximum"], "over maximum"))
            if "minLength" in rule:
                checks.append((F.length(text) < rule["minLength"], "too short"))
            if "maxLength" in rule:
                checks.append((F.length(text) > rule["maxLength"], "too long"))
            found += [F.when(there & fault, F.lit(f"{f}: {what}")).otherwise(none) for fault, what in checks]
        listed = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
        if schema.get("additionalProperties") is False:
            extra = F.array_except(F.json_object_keys(source), F.array(*[F.lit(f) for f in fields]))
            listed = F.concat(listed, F.transform(extra, lambda k: F.concat(k, F.lit(": unknown"))))
        checked = F.when(F.coalesce(whole, F.lit(False)), listed).otherwise(F.array(F.lit("arguments: not an object")))
        out = F.when(name == tool, checked).otherwise(out)
    return F.array_sort(out)


def _jumps(steps: DataFrame, longest: int) -> DataFrame:
    """``(key, up, w)``: of every call with a single dependency, the first call
    up its chain that hasn't one, and the steps to it.

    A row points up its chain; in each round it takes over the pointer of the
    row it points to, so that pointers double in length.  Rows on a cycle, or
    behind one, never end: once pointers are longer than any conversation
    (``longest`` calls) they are left out.
    """
    done, reach = Stack(steps.sparkSession, "jumps"), 1
    ends = steps.select("conv_id", "kind", F.col("call_id").alias("up"))
    open_ = steps.join(ends, ["conv_id", "kind", "up"], "left_semi")
    done.push(steps.join(ends, ["conv_id", "kind", "up"], "left_anti"))
    open_ = materialise(open_, "jumps")
    schema = steps.schema
    while open_.limit(1).count() and reach <= longest:
        reach *= 2
        known = done.read(schema).withColumn("ended", F.lit(True)).unionByName(open_.withColumn("ended", F.lit(False)))
        next_ = known.select("conv_id", "kind", F.col("call_id").alias("up"), F.col("up").alias("to"), F.col("w").alias("more"), "ended")
        moved = open_.join(next_, ["conv_id", "kind", "up"]).select(*_KEY, F.col("to").alias("up"), (F.col("w") + F.col("more")).alias("w"), "ended")
        moved = materialise(moved, "jumps")
        done.push(moved.where("ended").drop("ended"))
        open_ = moved.where("not ended").drop("ended")
    return done.read(schema)


def _levels(calls: DataFrame) -> DataFrame:
    """``(conv_id, kind, call_id, level)``: the longest chain of dependencies
    under each call, null for calls on a cycle or behind one.

    Chains of single dependencies are jumped over in logarithmically many
    rounds (:func:`_jumps`).  Calls with several dependencies are taken in
    Kahn's rounds, as many as such calls lie above each other.  Every round is
    added to a folder, so the plan stays as it is.  Dependencies that no call
    answers don't hold a call up.
    """
    ids = calls.select(*_KEY).distinct()
    needs = calls.select(*_KEY, F.explode("depends_on").alias("need")).distinct()
    known = ids.select("conv_id", "kind", F.col("call_id").alias("need"))
    needs = materialise(needs.join(known, ["conv_id", "kind", "need"], "left_semi"), "needs")
    degrees = needs.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"), F.max("need").alias("up"))
    degrees = materialise(degrees, "degrees")
    longest = degrees.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    jumps = _jumps(degrees.where("n = 1").select(*_KEY, "up", F.lit(1).cast("long").alias("w")), longest)
    several = degrees.where("n > 1").select(*_KEY)
    levels = Stack(calls.sparkSession, "levels")
    levels.push(ids.join(degrees, _KEY, "left_anti").withColumn("level", F.lit(0).cast("long")))
    schema = ids.withColumn("level", F.lit(0).cast("long")).schema
    if several.limit(1).count():
        # the end of each dependency's chain, and its steps
        over = jumps.select("conv_id", "kind", F.col("call_id").alias("need"), F.col("up").alias("end"), "w")
        lone = degrees.where("n = 1").select("conv_id", "kind", F.col("call_id").alias("need"), F.lit(True).alias("lone"))
        waits = needs.join(several, _KEY, "left_semi").join(over, ["conv_id", "kind", "need"], "left").join(lone, ["conv_id", "kind", "need"], "left")
        # a lone dependency without an end is on a cycle: it waits for itself
        end = F.when(F.col("lone") & F.col("end").isNull(), F.col("call_id")).otherwise(F.coalesce("end", "need"))
        waits = waits.select(*_KEY, end.alias("end"), (F.coalesce("w", F.lit(0)) + 1).alias("w"))
        waits = materialise(waits.groupBy(*_KEY, "end").agg(F.max("w").alias("w")), "waits")
        new = levels.read(schema)
        while True:
            met = waits.join(new.withColumnRenamed("call_id", "end"), ["conv_id", "kind", "end"], "left")
            met = met.select(*_KEY, F.when(F.col("level").isNull(), F.col("end")).alias("end"), (F.col("w") + F.coalesce("level", F.lit(0))).alias("w"))
            met = materialise(met.groupBy(*_KEY, "end").agg(F.max("w").alias("w")), "waits")
            ready = met.groupBy(*_KEY).agg(F.max("w").alias("level"), F.count("end").alias("left")).where("left = 0").drop("left")
            ready = materialise(ready, "ready")
            if not ready.limit(1).count():
                break
            levels.push(ready)
            new, waits = ready, met.join(ready, _KEY, "left_anti")
    known = levels.read(schema)
    ends = known.select("conv_id", "kind", F.col("call_id").alias("up"), F.col("level").alias("base"))
    chained = jumps.join(ends, ["conv_id", "kind", "up"]).select(*_KEY, (F.col("base") + F.col("w")).alias("level"))
    # calls without a level are on a cycle: they have no row
    return known.unionByName(chained).withColumn("level", F.col("level").cast("int"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call, and per result that no call asks for.

    Columns: conv_id, call_id, turn and pos of the call, level (topological;
    the order of a conversation is level, turn, pos, call_id), name, status,
    errors (of the arguments), missing (dependencies without a call), copies,
    n_results and json.  ``status`` is ``linked``, ``unanswered``, ``repeated``
    (a call whose identifier an earlier one has; it takes no result), ``cyclic``
    or ``orphan`` (a result alone).  Equal rows are counted in ``copies``; of
    several results the earliest is taken.  Rows without conv_id or call_id are
    unanswered or orphans.  ``kind`` parts name spaces (without one: 0).

    Calls and results are brought to one row for each identifier before they
    are joined, so neither a hot conversation nor a hot identifier is a hot
    task; the calls then find their identifier's row by a left join, whose
    large partitions Spark splits, and calls without an identifier stay out of
    it.
    """
    calls, results = (x if "kind" in x.columns else x.withColumn("kind", F.lit(0)) for x in (calls, results))
    calls = calls.groupBy(*_KEY, "turn", "pos", "name", "arguments", "depends_on").agg(F.count(F.lit(1)).alias("copies"))
    calls = materialise(calls, "calls")
    whole = "conv_id is not null and call_id is not null"
    named = calls.where(whole)
    at = F.struct("turn", "pos", "name", "arguments")
    heads = named.groupBy(*_KEY).agg(F.min(at).alias("head"))
    answers = results.groupBy(*_KEY).agg(F.min(F.struct("turn", "content")).alias("told"), F.count(F.lit(1)).alias("n_results"))
    links = heads.join(answers.where(whole), _KEY, "full").join(_levels(named), _KEY, "left")
    links = materialise(links, "links")
    asked = named.join(links.where("head is not null"), _KEY, "left")
    head = at.eqNullSafe(F.col("head"))
    status = F.when(~head, "repeated").when(F.col("level").isNull(), "cyclic").when(F.col("told").isNotNull(), "linked").otherwise("unanswered")
    asked = asked.withColumns({"status": status, "told": F.when(head, F.col("told")), "n_results": F.when(head, F.col("n_results"))}).drop("head")
    known = named.select("conv_id", "kind", F.col("call_id").alias("need")).distinct()
    missing = named.select(*_KEY, "turn", "pos", F.explode("depends_on").alias("need")).join(known, ["conv_id", "kind", "need"], "left_anti")
    missing = missing.groupBy(*_KEY, "turn", "pos").agg(F.array_sort(F.collect_set("need")).alias("missing"))
    asked = asked.join(missing, [*_KEY, "turn", "pos"], "left")
    nameless = calls.where(f"not ({whole})").withColumn("status", F.lit("unanswered"))
    alone = links.where("head is null").drop("head", "level").unionByName(answers.where(f"not ({whole})")).withColumn("status", F.lit("orphan"))
    out = asked.unionByName(nameless, allowMissingColumns=True).unionByName(alone, allowMissingColumns=True)
    # written before it is formatted: the plan of the joins ends here
    out = materialise(out, "linked")
    real = F.col("status") != "orphan"
    value = F.try_parse_json("arguments")
    source = F.to_json(value)
    errors = F.when(real, _errors(F.col("name"), source, value, schemas)).otherwise(F.array().cast("array<string>"))
    line = F.struct(
        value.alias("arguments"),
        F.col("call_id").alias("id"),
        F.col("level").alias("level"),
        F.col("name").alias("name"),
        F.try_parse_json("told.content").alias("result"),
        F.col("status"),
    )
    return out.select(
        "conv_id",
        "call_id",
        "turn",
        "pos",
        "level",
        "name",
        "status",
        errors.alias("errors"),
        F.coalesce("missing", F.array().cast("array<string>")).alias("missing"),
        F.coalesce("copies", F.lit(0)).cast("long").alias("copies"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        F.to_json(line, {"ignoreNullFields": "false"}).alias("json"),
    )


def format_chats(messages: DataFrame, schemas: dict[str, dict] | None = None) -> DataFrame:
    """:func:`link_calls` of the :func:`tool_traffic` of ``messages``, and
    their :func:`unlinked` ones: every message is in some row."""
    rows = _read(messages)
    linked = link_calls(*_traffic(rows), TURN_SCHEMAS if schemas is None else schemas)
    return linked.unionByName(_loose(rows))
