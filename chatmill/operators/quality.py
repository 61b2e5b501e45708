"""Checks of dialogues, exported lines, contracts and releases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chatmill.functions.text import onward, stripped

# Limits of the dialogue monitor, and the keys each kind of exported line must have.
LIMITS = {"empty_ratio": ("max", 0.01), "median_chars": ("min", 40.0), "role_balance": ("max", 0.30), "russian_ratio": ("min", 0.90), "duplicate_ratio": ("max", 0.05)}
REQUIRED_KEYS = {"sft_sharegpt_format": ("conversations",), "sft_openai_messages": ("messages",), "sft_alpaca_format": ("instruction", "output"), "rag_chunks_kb": ("content",), "dpo_preference_pairs": ("prompt", "chosen", "rejected")}


def dialogue_features(rows: DataFrame, key: str, messages: str) -> DataFrame:
    """Per dialogue: turns, empty answers, median answer length, role balance, Russian and repeated turns."""
    turns = F.transform(F.coalesce(messages, F.expr("array()")), lambda m: F.struct(F.lower(F.coalesce(m["role"], F.lit(""))).alias("role"), F.coalesce(m["content"], F.lit("")).alias("content")))
    frame = rows.select(F.col(key), turns.alias("t"))
    answers = F.filter("t", lambda m: m["role"] == "assistant")
    users = F.filter("t", lambda m: m["role"] == "user")
    lengths = F.array_sort(F.transform(F.filter(answers, lambda m: stripped(m["content"]) != ""), lambda m: F.length(m["content"])))
    n = F.size("t")
    frame = frame.select(key, "t", n.alias("turns"), F.size(answers).alias("answers"), F.size(users).alias("users"), F.size(F.filter(answers, lambda m: stripped(m["content"]) == "")).alias("empty_answers"), lengths.alias("l"))
    k = F.size("l")
    median = F.when(k == 0, 0.0).otherwise((F.element_at("l", F.floor((k + 1) / 2).cast("int")) + F.element_at("l", F.floor(k / 2).cast("int") + 1)) / 2.0)
    russian = F.size(F.filter("t", lambda m: m["content"].rlike("[а-яА-ЯёЁ]")))
    repeated = F.size(F.filter(F.zip_with("t", onward("t", 2), lambda a, b: b.isNotNull() & (stripped(a["content"]) == stripped(b["content"])) & (stripped(b["content"]) != "")), lambda x: x))
    some = F.col("turns") > 0
    return frame.select(
        key, F.col("turns").cast("long").alias("turns"), F.col("answers").cast("long").alias("answers"), F.col("empty_answers").cast("long").alias("empty_answers"), median.alias("median_chars"),
        F.when(some, F.abs(F.col("users") - F.col("answers")) / F.col("turns")).otherwise(1.0).alias("role_balance"),
        F.when(some, russian / F.col("turns")).otherwise(0.0).alias("russian_ratio"),
        F.when(some, repeated / F.greatest(F.col("turns") - 1, F.lit(1))).otherwise(0.0).alias("duplicate_ratio"),
    )


def dialogue_quality(rows: DataFrame, key: str, messages: str) -> DataFrame:
    """One row of corpus measures and the verdict: pass, fail, or no_data for an empty table.

    Dialogues without any readable answer fail.
    """
    f = dialogue_features(rows, key, messages)
    sums = f.agg(
        F.count("*").alias("dialogues"), F.coalesce(F.sum("answers"), F.lit(0)).alias("answers"), (F.sum("empty_answers") / F.greatest(F.sum("answers"), F.lit(1))).alias("empty_ratio"),
        F.median("median_chars").alias("median_chars"), F.avg("role_balance").alias("role_balance"), F.avg("russian_ratio").alias("russian_ratio"), F.avg("duplicate_ratio").alias("duplicate_ratio"),
    )
    good = F.col("answers") > 0
    for c, (side, limit) in LIMITS.items():
        good = good & ((F.col(c) <= limit) if side == "max" else (F.col(c) >= limit))
    return sums.withColumn("verdict", F.when(F.col("dialogues") == 0, "no_data").when(good, "pass").otherwise("fail"))


def turn_structure(rows: DataFrame, key: str, messages: str) -> DataFrame:
    """``conforms``: without system turns, a dialogue begins with the user, alternates and ends with the assistant.

    A dialogue without turns does not conform.
    """
    roles = F.transform(F.filter(F.coalesce(messages, F.expr("array()")), lambda m: ~m["role"].eqNullSafe("system")), lambda m: F.coalesce(m["role"], F.lit("")))
    frame = rows.select(key, roles.alias("r"))
    expected = F.transform("r", lambda x, i: F.when(i % 2 == 0, "user").otherwise("assistant"))
    return frame.select(key, ((F.size("r") > 0) & (F.size("r") % 2 == 0) & (F.col("r") == expected)).alias("conforms"))


def check_lines(rows: DataFrame, artifact: str, line: str) -> DataFrame:
    """Per artifact: lines, blank, corrupt (no JSON object) and without a required key."""
    state = F.when(F.trim(F.coalesce(line, F.lit(""))) == "", "blank").when(F.json_object_keys(line).isNull(), "corrupt")
    keys = F.coalesce(F.json_object_keys(line), F.array().cast("array<string>"))
    shaped = F.lit(True)
    for name, needed in REQUIRED_KEYS.items():
        shaped = shaped & ((F.col(artifact) != name) | (F.size(F.array_except(F.array(*[F.lit(k) for k in needed]), keys)) == 0))
    frame = rows.select(F.col(artifact), state.alias("s"), shaped.alias("shaped"))
    valid = F.col("s").isNull()
    return frame.groupBy(artifact).agg(F.count("*").alias("lines"), F.count_if(F.col("s") == "blank").alias("blank"), F.count_if(F.col("s") == "corrupt").alias("corrupt"), F.count_if(valid & ~F.coalesce("shaped", F.lit(True))).alias("shape_errors"), F.count_if(valid & F.coalesce("shaped", F.lit(True))).alias("valid"))


PROBED = ("phones", "emails", "api_keys", "crypto_wallets", "community_names")


def leak_probe(lines: DataFrame, line: str, order: Sequence[str], most: int = 10_000, communities: Sequence[str] = ()) -> DataFrame:
    """One row: lines probed, the redactions that the rules would still make in them by category, their sum, and ``passed``.

    The probe is the first ``most`` lines of a chat export in ``order``, as its feature is. Contents of a line's messages are
    joined; lines that aren't such objects have none. No lines pass no probe.
    """
    from chatmill.operators import scrub

    rules = [r for r in scrub.RULES if r.category in ("db_urls", "ssh_keys", "jwt_tokens", *PROBED)]
    some = lines.orderBy(*order).limit(most)
    said = F.from_json(F.col(line), "struct<messages: array<struct<content: string>>>")["messages"]["content"]
    texts = some.select(F.array_join(F.coalesce(said, F.array().cast("array<string>")), " ").alias("_said"))
    found = scrub.scrub(texts, "_said", [*rules, scrub.community_rule(communities)] if communities else rules)
    sums = {c: F.coalesce(F.sum(f"n_{c}"), F.lit(0)) if f"n_{c}" in found.columns else F.lit(0).cast("long") for c in PROBED}
    out = found.agg(F.count("*").alias("lines"), *[v.alias(k) for k, v in sums.items()])
    out = out.withColumn("leaks", sum((F.col(c) for c in PROBED[1:]), F.col(PROBED[0])))
    return out.withColumn("passed", (F.col("lines") > 0) & (F.col("leaks") == 0))


def check_contract(found: StructType, wanted: StructType, rows: int | None = None) -> tuple[str, list[str]]:
    """Verdict VALID, EMPTY or INVALID, and what differs: names, order or types of columns."""
    if rows == 0:
        return "EMPTY", ["no rows"]
    wrong = []
    if found.names != wanted.names:
        wrong.append(f"columns {found.names}, wanted {wanted.names}")
    for f in wanted.fields:
        if f.name in found.names and found[f.name].dataType.simpleString() != f.dataType.simpleString():
            wrong.append(f"{f.name} is {found[f.name].dataType.simpleString()}, wanted {f.dataType.simpleString()}")
    return ("INVALID" if wrong else "VALID"), wrong


def release_gate(reports: Mapping[str, Mapping | None], manifest_ok: bool, synthetic: bool = False) -> tuple[str, list[tuple[str, bool, str]]]:
    """SHIP or HOLD, with each check. Missing validation or audit holds; missing drift or reconciliation is skipped."""
    checks: list[tuple[str, bool, str]] = []
    v = reports.get("validation")
    checks.append(("validation", bool(v and v.get("overall_passed", v.get("passed", False))), "missing" if v is None else "read"))
    a = reports.get("audit")
    verdict = str((a or {}).get("verdict", (a or {}).get("status", ""))).upper()
    checks.append(("audit", a is not None and verdict in ("PASS", "PASSED", "SHIP", "OK"), verdict or "missing"))
    d = reports.get("drift")
    verdict = str((d or {}).get("overall_verdict", (d or {}).get("verdict", "stable"))).lower()
    checks.append(("drift", d is None or verdict in ("stable", "no_drift", "pass", "ok", "moderate_drift"), verdict if d else "skipped"))
    q = reports.get("sft_quality")
    if q is not None:
        verdict = q.get("overall_verdict")
        flag = q.get("passed", q.get("overall_passed"))
        ok = verdict.strip().lower() in ("pass", "passed", "ok", "ship") if isinstance(verdict, str) else flag is True
        checks.append(("sft_quality", ok, str(verdict if verdict is not None else flag)))
    s = reports.get("stats")
    if s is not None:
        checks.append(("volume", int(s.get("cleaned_messages_count") or 0) > 0, str(s.get("cleaned_messages_count"))))
    checks.append(("manifest", manifest_ok, ""))
    r = reports.get("reconciliation")
    checks.append(("reconciliation", r is None or str(r.get("status", "")).upper() in ("EXACT_MATCH", "DOCUMENTED_DIVERGENCE", "VERIFIED", "OK"), "skipped" if r is None else str(r.get("status"))))
    return ("SHIP" if all(ok for _, ok, _ in checks) and not synthetic else "HOLD"), checks


def reconcile(own: DataFrame, published: DataFrame, documented: Sequence[str] = ()) -> DataFrame:
    """Per artifact: differences of bytes and rows, and EXACT_MATCH, DOCUMENTED_DIVERGENCE or STRICT_MISMATCH.

    Both frames have artifact, sha256, bytes and rows; an artifact that one lacks mismatches.
    """
    both = own.alias("a").join(published.alias("b"), "artifact", "full_outer")
    same = F.col("a.sha256").eqNullSafe(F.col("b.sha256")) & F.col("a.rows").eqNullSafe(F.col("b.rows"))
    known = F.col("artifact").isin(*documented) if documented else F.lit(False)
    return both.select("artifact", (F.col("a.bytes") - F.col("b.bytes")).alias("bytes_delta"), (F.col("a.rows") - F.col("b.rows")).alias("rows_delta"), F.when(same, "EXACT_MATCH").when(known, "DOCUMENTED_DIVERGENCE").otherwise("STRICT_MISMATCH").alias("status"))


def training_coverage(runs: DataFrame, batch: int = 16, required: float = 100.0) -> DataFrame:
    """``runs`` with trainable, required_steps, coverage and compliant.

    Columns: actual_steps, total, holdout, max_samples, eval_frac, time_budget. A run complies if it took a full epoch over
    what is left after the held-out tail, without a cap below that pool and without a time limit.
    """
    pool = F.when((F.coalesce("holdout", F.lit(0)) > 0) & (F.col("total") > F.col("holdout")), F.col("total") - F.col("holdout")).otherwise(F.col("total"))
    capped = F.when((F.coalesce("max_samples", F.lit(0)) > 0) & (pool > F.col("max_samples")), F.col("max_samples")).otherwise(pool)
    left = F.greatest(F.when(F.coalesce("eval_frac", F.lit(0.0)) > 0, F.floor(capped * (1 - F.col("eval_frac")))).otherwise(capped), F.lit(0))
    steps = F.ceil(left / batch)
    seen = F.when(left > 0, F.least(F.lit(100.0), F.col("actual_steps") * batch / left * 100)).otherwise(0.0)
    good = (left > 0) & (F.col("actual_steps") >= steps) & (seen >= required) & ~(F.coalesce("max_samples", F.lit(0)) > 0).__and__(pool > F.col("max_samples")) & ~(F.coalesce("time_budget", F.lit(0.0)) > 0)
    return runs.withColumns({"trainable": left, "required_steps": steps, "coverage": seen, "compliant": F.coalesce(good, F.lit(False))})


def cyrillic(text: Column) -> Column:
    return F.coalesce(text.rlike("[а-яА-ЯёЁ]"), F.lit(False))
