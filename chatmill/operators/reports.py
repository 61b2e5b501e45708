"""Small derived figures and the rendering of reports."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.operators import scrub
from chatmill.sources.exports import lines_state


def load_report(path: str) -> dict:
    """A JSON report; {} if it is missing, unreadable or no object."""
    try:
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
    except (OSError, ValueError):
        return {}
    return found if isinstance(found, dict) else {}


def bar(value: float, most: float, width: int = 20) -> str:
    """A bar of blocks in proportion."""
    full = 0 if most <= 0 else round(width * min(1.0, max(0.0, value / most)))
    return "█" * full + "░" * (width - full)


def markdown(sections: Mapping[str, list[dict]], title: str = "Corpus report") -> str:
    """Each section as a table under a heading."""
    out = [f"# {title}"]
    for name, rows in sections.items():
        out += ["", f"## {name}", ""]
        if not rows:
            out.append("no rows")
            continue
        columns = list(rows[0])
        out += ["| " + " | ".join(columns) + " |", "|" + "-|" * len(columns)]
        out += ["| " + " | ".join(str(r[c]).replace("|", "\\|").replace("\n", " ") for c in columns) + " |" for r in rows]
    return "\n".join(out) + "\n"


def key_figures(stats: Mapping, analytics: Mapping) -> dict[str, int]:
    """Figures of a dashboard, from the pipeline's counts, else from the analytics report, else 0."""
    volume = (analytics.get("volume") or [{}])[0]
    first = lambda *values: next((int(v) for v in values if v), 0)
    return {"messages": first(stats.get("unique"), volume.get("messages")), "authors": first(volume.get("authors")), "tokens": first(volume.get("tokens")), "dialogues": first(stats.get("dialogues")), "pairs": first(stats.get("pairs"))}


def production_probe(rows: DataFrame, text: str, key: Column, size: int = 25_000, seed: int = 42) -> DataFrame:
    """One row: rows probed, redactions the rules would still make by category, foreign chat names and large chat ids.

    The probe is a uniform sample of at most ``size`` rows, those with the least hash: sampling is its purpose.
    Mentions and invites don't count.
    """
    drawn = rows.withColumn("_h", F.xxhash64(F.lit(seed), key)).orderBy("_h", key).limit(size).drop("_h")
    done = scrub.scrub(drawn, text, [r for r in scrub.RULES if r.category not in ("user_mentions", "private_invites")])
    sums = [F.sum(c).alias(c) for c in done.columns if c.startswith("n_")]
    return done.agg(F.count("*").alias("probed"), *sums, F.count_if(~F.startswith(F.col("chat_name"), F.lit("community_node_"))).alias("foreign_names"), F.count_if(F.col("chat_id") > 100_000).alias("large_chat_ids"))


def ci_stats(messages: DataFrame, lines: DataFrame, line: str) -> DataFrame:
    """One row: messages, distinct threads, valid and other lines."""
    m = messages.agg(F.count("*").alias("messages"), F.count_distinct("thread_id").alias("threads"))
    state = lines_state(lines, line).agg(F.count_if(F.col("state") == "valid").alias("valid_lines"), F.count_if(F.col("state") != "valid").alias("other_lines"))
    return m.crossJoin(F.broadcast(state))
