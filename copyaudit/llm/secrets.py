"""Secret scans: pattern matches, plus high-entropy windows of candidate strings, all as DataFrame expressions.

Base kinds are regular expressions. The method's own spans (kind ``entropy``) come from candidate strings, runs of token
characters that hold a letter and a digit, or both cases in like numbers: a window of ``WINDOW`` characters slides over the candidate, symbol counts
are updated as one character enters and one leaves, and the sum of c*log2(c) with them, so each step costs the same.
A window counts when its Shannon entropy reaches the bound of the candidate's character class (hex, alphanumeric, base64);
windows that touch merge into one span. The allow-list suppresses a candidate as a whole (an identifier, digits, a path of
plain names) or the part of it that matches (a date, a placeholder up to the next separator); the rest is scanned, as a
whole and part by part, and so is a path. Entropy spans inside a base span are suppressed. Entropy is kept in whole numbers (c*log2(c) in units of 2**-20), so results do not depend on the platform.

Positions are code points, end exclusive: the text split at the matches and the matches themselves give running lengths.

Defined cases: a null text is empty; an empty text has no spans and the digest of the empty string; repeated rows are
scanned one by one; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import floor, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from copyaudit.llm.common import let, span_list, table

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"             # the same matches as one or more, 20 characters kept
HEX = r"[0-9a-f]{24,}"                    # likewise
KINDS = ("assign", "access", "hex", "entropy")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
UNIT = 1 << 20
PER_WORD = 12                             # counts of 5 bits in one long


@dataclass(frozen=True)
class EntropyRule:
    """Least entropy in bits of a window, per class of the whole candidate; the first class that fits counts."""

    hex: float = 2.9
    alphanumeric: float = 3.7
    base64: float = 3.8
    # What is not worth reporting: patterns of candidates, or (pattern, "part") for the part of a candidate that matches.
    allow: tuple[str | tuple[str, str], ...] = ()

    def patterns(self, scope: str) -> list[str]:
        pairs = [(a, "whole") if isinstance(a, str) else a for a in self.allow]
        if wrong := [kind for _, kind in pairs if kind not in ("whole", "part")]:
            raise ValueError(f"an allowed pattern covers the whole or a part, not {wrong}")
        return [f"(?:{pattern})" for pattern, kind in pairs if kind == scope]


_NAME = r"(?:[a-z]*(?:[A-Z][a-z]+)*|[A-Z]*)[0-9]{0,4}"
_NAMES = rf"{_NAME}(?:[_=+-]{_NAME})*"
RULE = EntropyRule(allow=(
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",              # identifiers
    r"^[0-9=_/+-]+$",
    rf"^{_NAMES}(?:/{_NAMES}){{3,}}$",                                    # paths of plain names
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:T[0-9][0-9-]*)?", "part"),          # dates
    (r"[A-Za-z0-9+]*(?i:example|placeholder|changeme|xxxxx|00000000)[A-Za-z0-9+]*", "part"),
))
PATH = r"^[^/]*(/[^/]*){3,}$"
PART = rf"[A-Za-z0-9+]{{{WINDOW},}}"
LIKE_NUMBERS = 0.3                        # least share of either case among the letters of a candidate without digits


def _scaled(c: int) -> int:
    return round(c * log2(c) * UNIT) if c else 0


def _most(bits: float) -> int:
    """The largest sum of c*log2(c) in a window whose entropy is ``bits`` or more."""
    return floor(WINDOW * (log2(WINDOW) - bits) * UNIT)


def entropy_windows(candidate: Column, rule: EntropyRule = RULE) -> Column:
    """Merged spans ``(start, end)`` inside one candidate whose windows reach the bound of its class."""
    bound = F.when(candidate.rlike(r"^[0-9a-fA-F]+$"), _most(rule.hex)) \
        .when(candidate.rlike(r"^[A-Za-z0-9]+$"), _most(rule.alphanumeric)).otherwise(_most(rule.base64)).cast("long")
    codes = F.transform(F.split(candidate, ""), lambda ch: F.instr(F.lit(ALPHABET), ch) - 1)
    logs = F.array(*[F.lit(_scaled(c)).cast("long") for c in range(WINDOW + 1)])
    none = F.array().cast("array<struct<start:int,end:int>>")

    def shifted(code):
        return (code % PER_WORD * 5).cast("int")

    def count(counts, code):
        word = F.get(counts, F.floor(code / PER_WORD).cast("int"))
        return F.call_function("shiftright", word, shifted(code)).bitwiseAND(F.lit(31).cast("long")).cast("int")

    def changed(counts, code, by):
        return F.transform(counts, lambda v, k: F.when(
            k == F.floor(code / PER_WORD), v + by * F.call_function("shiftleft", F.lit(1).cast("long"), shifted(code)))
            .otherwise(v))

    def enter(state, code):
        c = count(state["counts"], code)
        return F.struct(changed(state["counts"], code, 1).alias("counts"),
                        (state["s"] + F.get(logs, c + 1) - F.get(logs, c)).alias("s"))

    def leave(state, code):
        c = count(state["counts"], code)
        return F.struct(changed(state["counts"], code, -1).alias("counts"),
                        (state["s"] + F.get(logs, c - 1) - F.get(logs, c)).alias("s"))

    def scan(all_codes):
        start = F.struct(
            F.array(*[F.lit(0).cast("long")] * -(-len(ALPHABET) // PER_WORD)).alias("counts"), F.lit(0).cast("long").alias("s"),
            F.lit(-1).alias("open"), F.lit(-1).alias("close"), none.alias("done"))

        def step(state, i):
            rolled = F.when(i >= WINDOW, leave(state, F.get(all_codes, i - WINDOW))) \
                .otherwise(F.struct(state["counts"].alias("counts"), state["s"].alias("s")))
            rolled = let(rolled, lambda r: enter(r, F.get(all_codes, i)))

            def marked(r):
                high = (i >= WINDOW - 1) & (r["s"] <= bound)
                first = i - (WINDOW - 1)
                fresh = high & ((state["open"] < 0) | (state["close"] < first))
                return F.struct(
                    r["counts"].alias("counts"), r["s"].alias("s"),
                    F.when(fresh, first).otherwise(state["open"]).alias("open"),
                    F.when(high, i + 1).otherwise(state["close"]).alias("close"),
                    F.when(fresh & (state["open"] >= 0), F.concat(state["done"], F.array(
                        F.struct(state["open"].alias("start"), state["close"].alias("end")))))
                    .otherwise(state["done"]).alias("done"))

            return let(rolled, marked)

        def finish(state):
            return F.when(state["open"] < 0, none).otherwise(F.concat(
                state["done"], F.array(F.struct(state["open"].alias("start"), state["close"].alias("end")))))

        return F.aggregate(F.sequence(F.lit(0), F.size(all_codes) - 1), start, step, finish)

    return let(codes, scan)


def _tagged(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                                                 s["end"].alias("end")))


NO_SPANS = "array<struct<start:int,kind:int,end:int>>"


def secret_spans(text: Column, rule: EntropyRule = RULE) -> tuple[Column, Column]:
    """Base spans and entropy spans of a text (not null), each an array of (start, kind, end) in order of start."""
    none = F.array().cast(NO_SPANS)

    def found(pattern, group=0):
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def spans(pattern):
        return span_list(F.split(text, pattern), found(pattern))

    values = found(ASSIGN, 2)
    assign = let(values, lambda v: F.filter(spans(ASSIGN), lambda _, i: F.length(F.get(v, i)) >= ASSIGN_VALUE))
    base = F.concat(
        F.when((text.contains(":") | text.contains("=")) & text.rlike(ASSIGN), _tagged(assign, "assign")).otherwise(none),
        F.when(text.contains("AKIA") & text.rlike(ACCESS), _tagged(spans(ACCESS), "access")).otherwise(none),
        F.when(text.rlike(HEX), _tagged(spans(HEX), "hex")).otherwise(none))

    def wanted(run):
        upper, lower = (F.length(F.regexp_replace(run, f"[^{letters}]", "")) for letters in ("A-Z", "a-z"))
        mixed = (upper >= LIKE_NUMBERS * (upper + lower)) & (lower >= LIKE_NUMBERS * (upper + lower))
        return (F.length(run) >= WINDOW) & run.rlike("[A-Za-z]") & (run.rlike("[0-9]") | mixed)

    whole, part = rule.patterns("whole"), "|".join(rule.patterns("part"))

    def piece(run, at):
        return F.struct(run.alias("run"), at.cast("int").alias("at"))

    def harmful(candidate):
        """The pieces to scan of a candidate with harmless parts, or of a path: what is left, whole and part by part."""
        def parts(p):
            found_parts = F.regexp_extract_all(p["run"], F.lit(PART), F.lit(0))
            return F.concat(F.array(piece(p["run"], p["at"])), let(found_parts, lambda f: F.transform(
                span_list(F.split(p["run"], PART), f), lambda s, i: piece(F.get(f, i), p["at"] + s["start"]))))

        between = F.split(candidate, part) if part else F.array(candidate)
        gone = span_list(between, F.regexp_extract_all(candidate, F.lit(part), F.lit(0)) if part else F.array().cast("array<string>"))
        rest = let(gone, lambda g: F.transform(between, lambda t, i: piece(
            t, F.when(i == 0, F.lit(0)).otherwise(F.get(g, i - 1)["end"]))))
        return F.filter(F.flatten(F.transform(rest, parts)), lambda p: wanted(p["run"]))

    def inside(candidate, at):
        nothing = F.array().cast("array<struct<run:string,at:int>>")
        allowed = candidate.rlike("|".join(whole)) if whole else F.lit(False)
        several = candidate.rlike("|".join([PATH, part] if part else [PATH]))
        pieces = F.when(~wanted(candidate) | allowed, nothing).when(~several, F.array(piece(candidate, F.lit(0)))) \
            .otherwise(harmful(candidate))
        spans = F.flatten(F.transform(pieces, lambda p: F.transform(entropy_windows(p["run"], rule), lambda s: F.struct(
            (at + p["at"] + s["start"]).alias("start"), F.lit(KINDS.index("entropy")).alias("kind"),
            (at + p["at"] + s["end"]).alias("end")))))
        return let(F.array_distinct(spans), lambda all_spans: F.filter(all_spans, lambda s: ~F.exists(
            all_spans, lambda o: (o["start"] <= s["start"]) & (o["end"] >= s["end"]) & (o != s))))

    candidates = found(CANDIDATE)
    entropy = let(candidates, lambda c: F.flatten(F.transform(
        span_list(F.split(text, CANDIDATE), c), lambda s, i: inside(F.get(c, i), s["start"]))))
    return F.sort_array(base), F.when(text.rlike(CANDIDATE), entropy).otherwise(none)


def spelled(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(documents: DataFrame, rule: EntropyRule = RULE) -> DataFrame:
    """Rows ``(doc_id, base, entropy)``: arrays of (start, kind, end), entropy spans inside a base span left out."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base, entropy = secret_spans(text, rule)
    found = documents.select("doc_id", F.struct(base.alias("base"), entropy.alias("entropy")).alias("found"))
    own = F.filter("found.entropy", lambda e: ~F.exists(
        "found.base", lambda b: (b["start"] <= e["start"]) & (b["end"] >= e["end"])))
    return found.select("doc_id", F.col("found.base").alias("base"), own.alias("entropy"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", number("assign"), number("access"), number("hex"),
                        F.sha2(spelled(F.col("base")), 256).alias("base_sha256"),
                        spelled(F.sort_array(F.concat("base", "entropy"))).alias("spans"))
