"""Secret scan: fixed patterns, and character Markov models against random strings.

Two first-order models, one of random strings and one of ordinary identifiers, are trained from labelled
samples: the values that the fixed patterns find are random, the words of texts without any match
are ordinary. A long token whose log-likelihood ratio favours randomness is a span
of kind ``random``. Everything is Spark expressions; only the table of ratios is made on the driver.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquarry.llm.common import stored
from fleetquarry.llm.spans import digest, joined, masked, matches, whole_text

# fixed values of the base kinds; possessive and behind a look-back, so each run is read once
_KEY = "(?i:(password|passwd|secret|token|api_?key))"
ASSIGN = _KEY + r"[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)"
ACCESS = "AKIA[A-Z0-9]++"
KINDS = ["assign", "access", "hex", "random"]
LEAST = {"assign": 6, "access": 20, "hex": 24}
# a run of at least this length is the run of a match, so shorter ones need no marks
HEX = f"(?<![0-9a-f])[0-9a-f]{{{LEAST['hex']},}}+"

#: Tokens that the models score, and the mean and total log-likelihood ratio (nats) to be reached.
TOKEN_LEAST = 20
TOKEN = f"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{TOKEN_LEAST},}}+"
MEAN_RATIO = 0.7
TOTAL_RATIO = 15.0
#: Weight of a letter's own frequency in the frequency of its transitions.
BACK_OFF = 5.0
#: Labelled samples: values of random strings, and texts whose words are ordinary.
RANDOM_SAMPLE = 20_000
TEXT_SAMPLE = 2_000
#: Letters of the models; every other character is one more.
LETTERS = string.ascii_letters + string.digits + "+/_-"
SIZE = len(LETTERS) + 1


def base_spans(text: Column) -> Column:
    """Base spans of a text that is not null, in the order start, then kind as listed."""
    assign = matches(
        text, "assign", ASSIGN, lambda p: F.char_length(F.regexp_extract(p, ASSIGN, 2)) >= LEAST["assign"],
        text.rlike(_KEY),
    )
    access = matches(text, "access", ACCESS, lambda p: F.char_length(p) >= LEAST["access"], F.contains(text, F.lit("AKIA")))
    hexes = matches(text, "hex", HEX, lambda p: F.lit(True), text.rlike(HEX))
    return in_order(F.concat(assign, access, hexes))


def in_order(spans: Column) -> Column:
    """By start, then by kind as listed."""
    place = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    return F.array_sort(
        spans,
        lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(
            (place(a) - place(b)).cast("int")
        ),
    )


def _code(letter: Column) -> Column:
    at = F.instr(F.lit(LETTERS), letter)
    return F.when(at > 0, at - 1).otherwise(SIZE - 1)


def _transitions(tokens: DataFrame) -> DataFrame:
    """Counts (label, a, b, n) of neighbouring letters in ``tokens(label, token)``."""
    pairs = tokens.select(
        "label",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.char_length("token") - 1), lambda i: F.substring("token", i, F.lit(2)))
        ).alias("pair"),
    )
    counted = pairs.groupBy("label", "pair").agg(F.count("*").alias("n"))
    codes = counted.select(
        "label", _code(F.substring("pair", 1, 1)).alias("a"), _code(F.substring("pair", 2, 1)).alias("b"), "n"
    )
    return codes.groupBy("label", "a", "b").agg(F.sum("n").alias("n"))


def _part(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df``, chosen by a hash of ``key``."""
    share = min(1.0, rows / max(1, df.count()))
    return df.where(F.pmod(F.xxhash64(key, F.lit(11)), F.lit(1 << 30)) < share * (1 << 30))


def train_ratios(base: DataFrame, docs: DataFrame) -> list[float]:
    """The log ratio of each transition under the two models, random over ordinary, row by row.

    ``base(doc_id, base)`` holds the base spans of ``docs``. Both samples are bounded (RANDOM_SAMPLE,
    TEXT_SAMPLE); the driver gets SIZE x SIZE counts a model. Where there is no random sample, all
    letters and digits count as equally likely in random strings.
    """
    values = base.select(F.explode("base").alias("s")).select(
        F.when(F.col("s.kind") == "assign", F.regexp_extract("s.value", ASSIGN, 2)).otherwise(F.col("s.value")).alias("token")
    )
    # an ordinary word may be assigned, too; random strings mix digits and letters
    values = values.where(F.col("token").rlike("[0-9]") & F.col("token").rlike("[A-Za-z]"))
    random = _part(values, F.col("token"), RANDOM_SAMPLE).select(F.lit(1).alias("label"), "token")
    plain = _part(base.where(F.size("base") == 0).select("doc_id"), F.col("doc_id"), TEXT_SAMPLE)
    words = docs.join(plain, "doc_id", "left_semi").select(
        F.lit(0).alias("label"),
        F.explode(F.regexp_extract_all(whole_text(F.col("text")), F.lit("(?<![0-9A-Za-z_-])([A-Za-z_-]{2,64})(?![0-9A-Za-z_-])"), 1)).alias("token"),
    )
    counts = {(r["label"], r["a"], r["b"]): r["n"] for r in _transitions(random.unionByName(words)).collect()}
    usual = 0 if any(label for label, _, _ in counts) else 1

    def logs(label: int) -> list[float]:
        flat = usual * label  # no sample: every letter alike
        single = [0.5 + flat + sum(counts.get((label, a, b), 0) for a in range(SIZE)) for b in range(SIZE)]
        whole, out = sum(single), []
        for a in range(SIZE):
            # letters that rarely follow a are as likely as they are at all
            row = [counts.get((label, a, b), 0) + BACK_OFF * single[b] / whole for b in range(SIZE)]
            total = math.log(sum(row))
            out += [math.log(x) - total for x in row]
        return out

    return [r - o for r, o in zip(logs(1), logs(0))]


def ratio(token: Column, ratios: list[float]) -> Column:
    """The token's log-likelihood ratio, random over ordinary."""
    table = F.array(*map(F.lit, ratios))
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(state: Column, letter: Column) -> Column:
        code = _code(letter)
        more = F.when(state["last"] < 0, F.lit(0.0)).otherwise(F.get(table, state["last"] * SIZE + code))
        return F.struct(code.alias("last"), (state["sum"] + more).alias("sum"))

    return F.aggregate(F.split(token, ""), start, step, lambda state: state["sum"])


def random_spans(text: Column, base: Column, ratios: list[float]) -> Column:
    """Tokens that look random and do not touch a base span."""

    def keep(token: Column) -> Column:
        score = ratio(token, ratios)
        reached = F.greatest(F.lit(TOTAL_RATIO), MEAN_RATIO * F.char_length(token))
        return score >= reached

    found = matches(text, "random", TOKEN, keep, text.rlike(TOKEN))
    return F.filter(found, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def scan(docs: DataFrame) -> DataFrame:
    """(row, base, spans) for every row of ``docs``: the row itself as a struct, and arrays of (start, kind,
    end, value), base spans in both.

    Null counts as empty; positions are code points, end exclusive. Repeated rows stay, and other columns may
    have any name. An empty table gives no rows.
    """
    text = whole_text(F.col("text"))
    base = stored(docs.select(F.col("doc_id").cast("long"), base_spans(text).alias("base")), "secrets")
    ratios = train_ratios(base, docs)
    own = docs.select(F.struct("*").alias("row"), text.alias("text")).withColumn("base", base_spans(F.col("text")))
    own = own.withColumn("spans", in_order(F.concat("base", random_spans(F.col("text"), F.col("base"), ratios))))
    return own.select("row", "base", "spans")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans) for every row of ``docs``."""
    found = scan(docs.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        *(count(k).alias(f"n_{k}") for k in KINDS),
        digest(F.col("base")).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by its kind in brackets, n_chars to match.

    Texts without secrets stay as they are, null included.
    """
    found = scan(docs)
    text = masked(whole_text(F.col("row.text")), F.col("spans"), lambda s: F.concat(F.lit("["), s["kind"], F.lit("]")))
    found = found.withColumn("redacted", F.when(F.size("spans") > 0, text))
    changed = {"text": F.coalesce("redacted", "row.text")}
    if "n_chars" in docs.columns:
        size = F.char_length("redacted").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.coalesce(size, "row.n_chars")
    return found.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
