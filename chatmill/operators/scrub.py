"""Rule-based redaction of contacts, secrets and addresses, as one chain of column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.functions.text import onward
from chatmill.operators import pseudonyms


@dataclass(frozen=True)
class Rule:
    category: str
    pattern: str
    replacement: str
    #: Texts one of which every match holds, so that the pattern is tried on few rows.
    holds: tuple[str, ...] = ()

    def may_match(self, text: Column) -> Column:
        if self.holds == ("0",):  # a phone number has ten digits or more
            return F.length(F.regexp_replace(text, r"(?U)\D+", "")) >= 10
        found = F.lit(not self.holds)
        for h in self.holds:
            found = found | F.contains(text, F.lit(h))
        return found


# Patterns of what is redacted and what takes its place, in the order of application.
RULES = (
    Rule("db_urls", r"(?iU)\b(?:postgres|postgresql|mysql|mongodb|redis|amqp)://[^\s]+\b", "[DATABASE_URL_REDACTED]", ("://",)),
    Rule("ssh_keys", r"-----BEGIN [A-Z ]+PRIVATE KEY-----[\s\S]+?-----END [A-Z ]+PRIVATE KEY-----", "[PRIVATE_KEY_REDACTED]", ("-----BEGIN ",)),
    Rule("api_keys", r"(?U)\bsk-(?:proj-)?[a-zA-Z0-9_\-]{20,}\b", "[API_KEY_REDACTED]", ("sk-",)),
    Rule("api_keys", r"(?U)\b(?:ghp|gho|ghu|ghs|ghr)_[a-zA-Z0-9]{20,50}\b|\bgithub_pat_[a-zA-Z0-9_]{30,}\b", "[API_KEY_REDACTED]", ("gh", "github_pat_")),
    Rule("api_keys", r"(?U)\b\d{8,12}:[a-zA-Z0-9_\-]{25,45}\b", "[BOT_TOKEN_REDACTED]", (":",)),
    Rule("api_keys", r"(?U)\b(?:AKIA|ABIA|ACCA|ASIA)[0-9A-Z]{16}\b", "[AWS_KEY_REDACTED]", ("AKIA", "ABIA", "ACCA", "ASIA")),
    Rule("jwt_tokens", r"(?U)\beyJ[a-zA-Z0-9_-]{10,}\.eyJ[a-zA-Z0-9_-]{10,}\.[a-zA-Z0-9_-]{10,}\b", "[JWT_TOKEN_REDACTED]", ("eyJ",)),
    Rule("api_keys", r"""(?iU)((?:api_key|apikey|secret_key|private_key|auth_token|client_secret|password|access_token)\s*[:=]\s*["'])([a-zA-Z0-9_\-\.]{12,})(["'])""", "$1[SECRET_REDACTED]$3", ("\"", "'")),
    Rule("crypto_wallets", r"(?U)\b(?:1[a-km-zA-HJ-NP-Z1-9]{25,34}|3[a-km-zA-HJ-NP-Z1-9]{25,34}|bc1[a-z0-9]{39,59})\b", "[CRYPTO_WALLET_BTC]", ("1", "3")),
    Rule("crypto_wallets", r"(?U)\b0x[a-fA-F0-9]{40}\b", "[CRYPTO_WALLET_ETH]", ("0x",)),
    Rule("crypto_wallets", r"(?U)\bT[A-Za-z1-9]{33}\b", "[CRYPTO_WALLET_TRON]", ("T",)),
    Rule("crypto_wallets", r"(?U)\b(?:EQ|UQ)[a-zA-Z0-9_-]{46}\b", "[CRYPTO_WALLET_TON]", ("EQ", "UQ")),
    Rule("emails", r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,7}\b", "[EMAIL_REDACTED]", ("@",)),
    Rule("phones", r"(?U)(?<![\w=])(?!\d+\.\d+\.\d+\b)(?:(?:\+?[78]|\+?380|\+?995|\+?374|\+?998|\+?375|\+?1)[\s\-\(]*\d\s*\d\s*\d[\s\-\)]*\d\s*\d\s*\d[\s\-]*\d\s*\d[\s\-]*\d\s*\d\b|(?:\+\d{1,3}[\s\-]?)?\(?\d{3,4}\)?[\s\-]?\d{3}[\s\-]?\d{2}[\s\-]?\d{2}\b)", "[PHONE_REDACTED]", ("0",)),
    Rule("ip_addresses", r"(?U)\b(?!(?:127\.0\.0\.1|1\.1\.1\.1|8\.8\.8\.8|8\.8\.4\.4)\b)(?!0+\.)(?!(?:0*[0-9]\.){3}0*[0-9]\b)(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\b", "[IP_REDACTED]", (".",)),
    Rule("private_invites", r"(?i)t\.me/(?:\+|joinchat/)[a-zA-Z0-9_\-]+", "t.me/[INVITE_LINK_REDACTED]", ("/",)),
    Rule("user_mentions", r"(?U)(?<!\w)@([a-zA-Z0-9_]{4,32})\b", "@user_anon", ("@",)),
)
CATEGORIES = tuple(dict.fromkeys(r.category for r in RULES)) + ("community_names",)


def community_rule(names: Sequence[str]) -> Rule:
    """Redacts the given community names, whatever their case and spacing."""
    spaced = "|".join(r"\s+".join(f"\\Q{w}\\E" for w in n.split()) for n in sorted(names, key=len, reverse=True))
    return Rule("community_names", rf"(?iuU)\b(?:{spaced})\b", "[COMMUNITY_REDACTED]")


def scrubbed(text: Column, rules: Sequence[Rule] = RULES) -> Column:
    for r in rules:
        text = F.regexp_replace(text, r.pattern, r.replacement)
    return text


def tidied(text: Column) -> Column:
    """Repeated placeholders, runs of spaces and of blank lines drawn together."""
    text = F.regexp_replace(text, r"(?:\[PERSON_REDACTED\]\s*){2,}", "[PERSON_REDACTED] ")
    text = F.regexp_replace(text, r"(?:\[PHONE_REDACTED\]\s*){2,}", "[PHONE_REDACTED] ")
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"[ \t]{2,}", " "), r"\n{3,}", "\n\n"))


def scrub(rows: DataFrame, column: str, rules: Sequence[Rule] = RULES, out: str = "text_scrubbed", counts: bool = True) -> DataFrame:
    """``rows`` with the redacted text and, for each category, how many redactions were made (prefix ``n_``).

    Each rule sees what those before it left. Null stays null with counts of 0. Everything is regular expressions in
    the scan's own stage. A pattern is tried only where a text it needs is there, and replaced only where it was found. The
    text is kept as one column a rule, so that no expression is evaluated twice.
    """
    frame = rows.withColumn("_t0", F.col(column))
    for k, r in enumerate(rules):
        t = F.col(f"_t{k}")
        count = F.when(t.isNotNull() & r.may_match(t), F.regexp_count(t, F.lit(r.pattern))).otherwise(0)
        frame = frame.withColumn(f"_n{k}", count).withColumn(f"_t{k + 1}", F.when(F.col(f"_n{k}") > 0, F.regexp_replace(t, r.pattern, r.replacement)).otherwise(t))
    kept = [F.col(f"`{c}`") for c in rows.columns]
    totals = []
    if counts:
        for category in dict.fromkeys(r.category for r in rules):
            some = [F.col(f"_n{k}") for k, r in enumerate(rules) if r.category == category]
            totals.append(sum(some[1:], some[0]).cast("long").alias(f"n_{category}"))
    return frame.select(*kept, F.col(f"_t{len(rules)}").alias(out), *totals)


def scrub_forwards(rows: DataFrame, column: str, known: DataFrame, order: Sequence[str], rules: Sequence[Rule] = RULES, out: str = "text_scrubbed", counts: bool = True) -> DataFrame:
    """``scrub`` with pseudonyms for the names in forward headers (``n_forward_headers``), between database URLs and the rest.

    ``known`` are the authors' pseudonyms, ``order`` the columns by which further names are numbered.
    """
    early = scrub(rows, column, [r for r in rules if r.category == "db_urls"], "_early", counts)
    if counts:
        early = early.withColumn("n_forward_headers", F.coalesce(F.regexp_count("_early", F.lit(pseudonyms.FORWARD)), F.lit(0)).cast("long"))
    named = pseudonyms.forward_headers(early, "_early", known, order)
    return scrub(named, "_early", [r for r in rules if r.category != "db_urls"], out, counts).drop("_early")


MENTION = r"(?U)(?<!\w)@([a-zA-Z0-9_]{4,32})\b"


def numbered_mentions(rows: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """``mention`` in lower case and ``number`` by first occurrence in the order of the rows, then within the text."""
    from chatmill.plans.ranks import with_position

    found = rows.where(F.contains(F.col(column), F.lit("@"))).select(F.struct(*order).alias("_at"), F.posexplode(F.regexp_extract_all(F.col(column), F.lit(MENTION), 1)).alias("_pos", "m"))
    first = found.groupBy(F.lower("m").alias("mention")).agg(F.min(F.struct("_at", "_pos")).alias("_first"))
    return with_position(first, [F.col("_first"), F.col("mention")], "number", first=1).select("mention", "number")


def number_mentions(rows: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with each mention in ``column`` replaced by @user_ and its number; null stays null.

    Only texts with a mention are moved, and of equal ones the mentions are looked up once.
    """
    numbers = numbered_mentions(rows, column, order)
    has = F.coalesce(F.contains(F.col(column), F.lit("@")), F.lit(False))
    held = rows.where(has).withColumn("_text", F.md5(column))
    found = held.select("_text", F.posexplode(F.regexp_extract_all(column, F.lit(MENTION), 1)).alias("_pos", "m")).select("_text", "_pos", F.lower("m").alias("mention")).distinct()
    marks = found.join(numbers, "mention").groupBy("_text").agg(F.array_sort(F.collect_list(F.struct("_pos", F.concat(F.lit("@user_"), F.col("number")).alias("by")))).alias("_marks"))
    pieces = F.split(column, MENTION, -1)
    put = F.zip_with(F.col("_marks.by"), onward(pieces, 2), lambda by, rest: F.concat(by, rest))
    done = held.join(marks, "_text", "left").withColumn(column, F.when(F.col("_marks").isNull(), F.col(column)).otherwise(F.concat(F.element_at(pieces, 1), F.array_join(put, ""))))
    return done.select(*rows.columns).unionByName(rows.where(~has))
