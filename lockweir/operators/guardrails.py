"""Guardrail rules as expressions, verdicts, two-sided checks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.arrays import let
from ..functions.formats import fixed
from ..sources.request_log import append_batch
from .once import once
from .pii import detect_fast

VIOLATION = (
    "struct<rule_name:string,severity:string,action:string,message:string,details:string>"
)


class Rule:
    """Plug-in point: subclass it and return a violation Column, null when the rule holds."""

    kind = "custom"

    def __init__(self, name: str, enabled: bool = True, severity: str = "warning",
                 action: str = "log", side: str = "both"):
        self.name, self.enabled, self.severity, self.action = name, enabled, severity, action
        self.side = side

    def check(self, text: Column, entities: Column, tokens: Column, cost: Column) -> Column:
        raise NotImplementedError

    def violation(self, broken: Column, message: Column, **details: Column) -> Column:
        """A violation where ``broken`` is true; details are stored as one JSON text."""
        body = F.to_json(F.struct(message.alias("message"), *[v.alias(k) for k, v in details.items()]))
        row = F.struct(
            F.lit(self.name).alias("rule_name"),
            F.lit(self.severity).alias("severity"),
            F.lit(self.action).alias("action"),
            message.alias("message"),
            body.alias("details"),
        )
        return F.when(broken, row)


class MaxTokens(Rule):
    kind = "threshold"

    def __init__(self, threshold: int, **kw):
        super().__init__(**kw)
        self.threshold = threshold

    def check(self, text, entities, tokens, cost):
        message = F.concat(
            F.lit("Token count "), tokens.cast("string"), F.lit(f" exceeds threshold {self.threshold}")
        )
        return self.violation(tokens > self.threshold, message, tokens=tokens, threshold=F.lit(self.threshold))


class MaxCost(Rule):
    kind = "threshold"

    def __init__(self, threshold: float, **kw):
        super().__init__(**kw)
        self.threshold = threshold

    def check(self, text, entities, tokens, cost):
        message = F.concat(
            F.lit("Cost $"), fixed(cost, 4), F.lit(f" exceeds threshold ${self.threshold:.4f}")
        )
        return self.violation(cost > self.threshold, message, cost=cost, threshold=F.lit(self.threshold))


class NoPII(Rule):
    kind = "pii"

    def __init__(self, entity_types=None, **kw):
        super().__init__(**kw)
        self.entity_types = list(entity_types or [])

    def check(self, text, entities, tokens, cost):
        def listed(found: Column) -> Column:
            quoted = F.transform(found, lambda e: F.concat(F.lit("'"), e["type"], F.lit("'")))
            message = F.concat(F.lit("PII detected: ["), F.array_join(quoted, ", "), F.lit("]"))
            told = let(message, lambda text: self.violation(F.lit(True), text, entities=found))
            return F.when(F.size(found) > 0, told)

        return let(of_types(entities, self.entity_types), listed)


class ContentFilter(Rule):
    kind = "content"

    def __init__(self, patterns, **kw):
        super().__init__(**kw)
        self.patterns = list(patterns)

    def check(self, text, entities, tokens, cost):
        return self.violation(
            content_matches(text, self.patterns),
            F.lit("Content matches filtered patterns"),
            patterns=F.array(*[F.lit(p) for p in self.patterns]),
        )


def of_types(entities: Column, types: list[str]) -> Column:
    """Entities of the listed types; an empty list means any."""
    if not types:
        return entities
    return F.filter(entities, lambda e: e["type"].isin(*types))


def content_matches(text: Column, patterns: list[str]) -> Column:
    """Whether any pattern is found, ignoring case; each is searched by itself.

    A ``.*`` or ``.*?`` at the start, with no further quantifier, cannot change whether a search
    succeeds, but would make it walk each line once per character; it is left out.
    """
    found = F.lit(False)
    for p in patterns:
        core = re.sub(r"^(?:\.\*\??(?![?+*{]))+", "", p)
        found = found | text.rlike(f"(?iu){core}")
    return F.coalesce(found & (text != ""), F.lit(False))


def pii_at_least(entities: Column, types: list[str] | None, n: int = 1) -> Column:
    return F.size(of_types(entities, list(types or []))) >= n


def compare(value: Column, threshold: Column, op: Column | str = "gt") -> Column:
    """gt, gte, lt, lte or eq, given as a name or a column; any other name is false."""
    op = F.lit(op) if isinstance(op, str) else op
    return (
        F.when(op == "gt", value > threshold)
        .when(op == "gte", value >= threshold)
        .when(op == "lt", value < threshold)
        .when(op == "lte", value <= threshold)
        .when(op == "eq", value == threshold)
        .otherwise(F.lit(False))
    )


def make_rule(spec: dict, custom: bool = False) -> Rule | None:
    """A rule from its description; unknown types give none. Only custom threshold rules can
    be about cost."""
    base = {
        "name": spec.get("name", ""),
        "enabled": spec.get("enabled", True),
        "severity": spec.get("severity", "warning"),
        "action": spec.get("action", "log"),
        "side": spec.get("side", "both"),
    }
    kind = spec.get("type", "")
    if kind == "threshold":
        about = (spec.get("name", "") + " " + spec.get("description", "")).lower()
        rule = MaxCost if custom and "cost" in about else MaxTokens
        return rule(threshold=spec.get("threshold", 0), **base)
    if kind == "pii":
        return NoPII(entity_types=spec.get("entity_types", []), **base)
    if kind == "content":
        return ContentFilter(patterns=spec.get("patterns", []), **base)
    return None


def load_rules(builtin=config.BUILTIN_RULES, custom=config.CUSTOM_RULES) -> list[Rule]:
    """Built-in rules, then custom ones, each once."""
    rules = [make_rule(s) for s in builtin] + [make_rule(s, custom=True) for s in custom]
    return [r for r in rules if r is not None]


def load_rules_yaml(path: str) -> list[Rule]:
    """Custom rules from a YAML file on the driver, after the built-in ones."""
    try:
        import yaml
    except ImportError as e:  # pragma: no cover
        raise RuntimeError("reading rules from YAML needs the yaml package") from e
    with open(path) as f:
        spec = yaml.safe_load(f) or {}
    return load_rules(custom=spec.get("rules", []))


def rules_df(spark: SparkSession, rules: list[Rule] | None = None) -> DataFrame:
    rules = load_rules() if rules is None else rules
    return spark.createDataFrame(
        [(i, r.name, r.kind, r.enabled, r.severity, r.action) for i, r in enumerate(rules)],
        "position int, name string, type string, enabled boolean, severity string, action string",
    )


def verdict(
    df: DataFrame,
    rules: list[Rule] | None = None,
    text: Column | None = None,
    entities: Column | None = None,
    tokens: Column | None = None,
    cost: Column | None = None,
    prefix: str = "",
    side: str | None = None,
    enabled: bool = True,
    block_on_violation: bool = True,
) -> DataFrame:
    """Add ``violations``, ``passed`` and ``should_block``. Inputs left out count as null.

    All rules become one array expression of the same projection: no shuffle, no UDF.
    """
    rules = load_rules() if rules is None else rules
    if side is not None:
        rules = [r for r in rules if r.side in ("both", side)]
    text = F.lit(None).cast("string") if text is None else text
    tokens = F.lit(None).cast("long") if tokens is None else tokens
    cost = F.lit(None).cast("double") if cost is None else cost
    if entities is None:
        from ..functions.spans import SPAN_ARRAY

        entities = F.array().cast(SPAN_ARRAY)
    checks = [r.check(text, entities, tokens, cost).cast(VIOLATION) for r in rules if r.enabled] if enabled else []
    found = F.filter(F.array(*checks), lambda v: v.isNotNull()) if checks else F.array().cast(f"array<{VIOLATION}>")
    out = once(df, **{f"{prefix}violations": found})
    v = F.col(f"{prefix}violations")
    blocks = F.exists(v, lambda x: x["severity"] == "error") if block_on_violation else F.lit(False)
    return out.withColumn(f"{prefix}passed", F.size(v) == 0).withColumn(f"{prefix}should_block", blocks)


def two_pass(
    df: DataFrame,
    rules: list[Rule] | None = None,
    prompt: str = "prompt",
    completion: str = "completion",
    tokens: Column | None = None,
    cost: Column | None = None,
) -> DataFrame:
    """Check the prompt, and the completion only where it holds personal data; either may block."""
    found = once(df, in_entities=detect_fast(prompt), out_entities=detect_fast(completion))
    checked = verdict(
        found, rules, F.col(prompt), F.col("in_entities"), tokens, cost, prefix="in_", side="input"
    )
    checked = verdict(
        checked, rules, F.col(completion), F.col("out_entities"), tokens, cost, prefix="out_", side="output"
    )
    clean = F.size("out_entities") == 0
    return (
        checked.withColumn("out_passed", clean | F.col("out_passed"))
        .withColumn("out_should_block", ~clean & F.col("out_should_block"))
        .withColumn("out_violations", F.when(clean, F.array().cast(f"array<{VIOLATION}>")).otherwise(F.col("out_violations")))
        .withColumn("blocked", F.col("in_should_block") | F.col("out_should_block"))
    )


def turn_pairs(conversations: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right after it, null if there is none.

    An equi join on ``(conv_id, turn)`` spreads even a conversation that holds most turns.
    """
    ask = conversations.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("prompt")
    )
    reply = conversations.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("completion")
    )
    return ask.join(reply, ["conv_id", "turn"], "left")


def violations_to_log(df: DataFrame, keys: list[str], violations: str = "violations") -> DataFrame:
    """One row per violation, ready to append; ``details`` is JSON with the message first."""
    rows = df.select(*keys, F.posexplode_outer(violations).alias("position", "v"))
    return rows.filter(F.col("v").isNotNull()).select(
        *keys,
        "position",
        F.col("v.rule_name").alias("rule_name"),
        F.col("v.severity").alias("severity"),
        F.col("v.action").alias("action"),
        F.col("v.details").alias("details"),
    )


def append_violations(log: DataFrame, path: str, time: str = "timestamp", batch_id: int = 0) -> None:
    """Append to the violation log; a batch that is written again replaces its own rows."""
    append_batch(log.withColumn("violation_date", F.to_date(time)), path, "violation_date", batch_id)
