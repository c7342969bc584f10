"""Secret scans in Spark SQL functions only.

Base spans.  Three patterns are matched leftmost and without overlap over the
whole text: assignments of a value to a secret-like name, access keys and long
hexadecimal runs.  Spark returns matches without places, so a text is also
split by the same pattern: the pieces between matches and the matches
alternate, and running lengths give every start and end in code points.

Entropy spans.  Runs of token characters are candidates; a run that base spans
touch is cut there, and each piece of ``WINDOW`` characters or more is a
candidate of its own.  An allow list drops what is known to be harmless (plain words,
numbers, identifiers, paths, UUIDs, runs of one class).  In the rest a window
of ``WINDOW`` characters slides over the run.  The state keeps one count per
symbol of the run's character class and the running sum of c * log2(c); each
step takes the leaving character off and puts the entering one on, so the
window's Shannon entropy, log2(W) - sum / W, costs two updates.  Windows at
or above the class's limit merge into spans, kind ``entropy``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The three base patterns and the least lengths kept.
ASSIGN = (r"""(?=[AaPpSsTt])(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}+"       # AKIA and a run, 20 characters or more
HEX = r"[0-9a-f]{24,}+"
ASSIGN_VALUE = 6

TOKEN = r"[A-Za-z0-9+/_=-]{20,}+"    # candidates of the entropy scan
WINDOW = 20
# character classes, first match wins: (name, pattern, symbols counted, least entropy in bits of a window)
CLASSES = (
    ("hex", "[0-9A-Fa-f]+", "0123456789ABCDEFabcdef", 3.0),
    ("upper", "[A-Z0-9]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 3.6),
    ("lower", "[a-z0-9]+", "abcdefghijklmnopqrstuvwxyz0123456789", 3.6),
    ("mixed", ".*", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.85),
)
# Allow list: candidates that fully match one of these are no secrets.
ALLOW = (
    r"[A-Za-z]+",                                             # words run together
    r"[0-9_=+/-]+",                                           # numbers, rules of signs
    r"[A-Za-z]+([_/+=-]+[A-Za-z]*)*",                         # paths and joined words without a digit
    r"[A-Za-z]+[0-9]{1,4}",                                   # a word and a number
    r"[0-9]{1,4}[A-Za-z]+",
    r"([A-Za-z]+|[0-9]+)([_/-]([A-Za-z]+|[0-9]+))+",          # slugs, dates, versioned paths
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
)


_ALLOWED = "^(" + "|".join(f"(?:{p})" for p in ALLOW) + ")$"

KINDS = ("assign", "access", "hex", "entropy")    # order of spans that start together
MASK = "[SECRET]"
_SPANS = "array<struct<start:int,ord:int,stop:int,kind:string,hit:string>>"


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def match_spans(text: Column, hits: Column, pattern: str, kind: str) -> Column:
    """Array of (start, ord, stop, kind, hit) of each of the ``hits`` that
    ``pattern`` has in the text; only a text with hits is split."""
    order = KINDS.index(kind)
    # the piece after the last match has no match to go with: hit is null there
    steps = F.zip_with(F.split(text, pattern, -1), hits, lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit")))

    def step(state, s):
        start = state["at"] + s["gap"]
        stop = start + F.length(s["hit"])
        span = F.struct(start.alias("start"), F.lit(order).alias("ord"), stop.alias("stop"), F.lit(kind).alias("kind"),
                        s["hit"].alias("hit"))
        return F.when(s["hit"].isNull(), state).otherwise(
            F.struct(stop.alias("at"), F.array_append(state["spans"], span).alias("spans")))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))
    return F.when(F.size(hits) > 0, F.aggregate(steps, first, step, lambda s: s["spans"])).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column, assign: Column, access: Column, hexes: Column) -> Column:
    """Spans of the three base patterns, by start, then kind."""
    assigned = F.filter(match_spans(text, assign, ASSIGN, "assign"),
                        lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 1)) >= ASSIGN_VALUE)
    found = F.concat(assigned, match_spans(text, access, ACCESS, "access"), match_spans(text, hexes, HEX, "hex"))
    return F.array_sort(F.transform(found, lambda s: F.struct(s["start"], s["ord"], s["stop"], s["kind"])))


def entropy_stretches(token: Column) -> Column:
    """Merged [a, b) stretches of ``token`` covered by windows of WINDOW
    characters whose Shannon entropy reaches the limit of the token's class."""
    def by_class(values) -> Column:
        out = F.lit(values[-1])
        for (_, pattern, _, _), value in list(zip(CLASSES, values))[-2::-1]:
            out = F.when(token.rlike("^" + pattern + "$"), F.lit(value)).otherwise(out)
        return out

    alphabet = by_class([c[2] for c in CLASSES])
    # the largest sum of c * log2(c) whose window reaches the limit
    worst = by_class([(math.log2(WINDOW) - c[3]) * WINDOW + 1e-9 for c in CLASSES])
    came = F.transform(F.split(token, ""), lambda c: F.call_function("instr", alphabet, c))
    went = F.concat(F.array_repeat(F.lit(-1), WINDOW), came)
    steps = F.slice(F.zip_with(came, went, lambda c, g: F.struct(c.alias("came"), g.alias("gone"))), 1, F.length(token))
    most = max(len(c[2]) for c in CLASSES)

    def weight(count: Column) -> Column:
        return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))

    def step(state, s):
        i = state["at"]
        n_came = F.get(state["n"], s["came"])
        n_gone = F.when(s["gone"] >= 0, F.get(state["n"], F.greatest(s["gone"], F.lit(0)))).otherwise(F.lit(0))
        same = s["came"] == s["gone"]
        total = state["sum"] + F.when(same, F.lit(0.0)).otherwise(
            weight(n_came + 1) - weight(n_came) + F.when(n_gone > 0, weight(n_gone - 1) - weight(n_gone)).otherwise(F.lit(0.0)))
        counts = F.when(same, state["n"]).otherwise(F.transform(state["n"], lambda c, k: c + F.when(
            k == s["came"], F.lit(1)).when(k == s["gone"], F.lit(-1)).otherwise(F.lit(0))))
        return F.struct((i + 1).alias("at"), counts.alias("n"), total.alias("sum"), state["a"].alias("a"),
                        state["b"].alias("b"), state["worst"].alias("worst"), state["done"].alias("done"))

    def merge(state):
        """After a step: is the window that ends here high, and does it touch the open stretch?"""
        high = (state["at"] >= WINDOW) & (state["sum"] <= state["worst"])
        first = state["at"] - WINDOW
        fresh = high & (state["b"] < first)
        return F.struct(state["at"].alias("at"), state["n"].alias("n"), state["sum"].alias("sum"),
                        F.when(fresh, first).otherwise(state["a"]).alias("a"),
                        F.when(high, state["at"]).otherwise(state["b"]).alias("b"), state["worst"].alias("worst"),
                        F.when(fresh & (state["b"] >= 0), F.array_append(
                            state["done"], F.struct(state["a"].alias("a"), state["b"].alias("b"))))
                        .otherwise(state["done"]).alias("done"))

    first = F.struct(F.lit(0).alias("at"), F.array_repeat(F.lit(0), most + 1).alias("n"), F.lit(0.0).alias("sum"),
                     F.lit(-1).alias("a"), F.lit(-1).alias("b"), worst.alias("worst"),
                     F.array().cast("array<struct<a:int,b:int>>").alias("done"))
    # a one-element transform binds the new state once for the merge
    return F.aggregate(steps, first, lambda st, s: F.get(F.transform(F.array(step(st, s)), merge), F.lit(0)),
                       lambda st: F.when(st["b"] >= 0, F.array_append(
                           st["done"], F.struct(st["a"].alias("a"), st["b"].alias("b")))).otherwise(st["done"]))


def _pieces(run: Column, base: Column) -> Column:
    """What base spans leave of a run: (start, hit) of WINDOW characters or more."""
    touching = F.filter(base, lambda b: (b["start"] < run["stop"]) & (run["start"] < b["stop"]))
    first = F.struct(run["start"].alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("left"))

    def until(state, stop):
        return F.array_append(state["left"], F.struct(state["at"].alias("start"), stop.alias("stop")))

    left = F.aggregate(touching, first, lambda st, b: F.struct(F.greatest(st["at"], b["stop"]).alias("at"), until(st, b["start"]).alias("left")),
                       lambda st: until(st, run["stop"]))
    long = F.filter(left, lambda p: p["stop"] - p["start"] >= WINDOW)
    return F.transform(long, lambda p: F.struct(p["start"].alias("start"), F.substring(
        run["hit"], p["start"] - run["start"] + 1, p["stop"] - p["start"]).alias("hit")))


def entropy_spans(text: Column, tokens: Column, base: Column) -> Column:
    """Spans of the entropy scan over the token runs, cut at base spans; runs
    and pieces that the allow list knows are left out."""
    order, kind = KINDS.index("entropy"), "entropy"
    runs = F.filter(match_spans(text, tokens, TOKEN, kind), lambda r: ~r["hit"].rlike(_ALLOWED))
    free = F.filter(F.flatten(F.transform(runs, lambda r: _pieces(r, base))), lambda p: ~p["hit"].rlike(_ALLOWED))
    return F.flatten(F.transform(free, lambda p: F.transform(entropy_stretches(p["hit"]), lambda e: F.struct(
        (p["start"] + e["a"]).alias("start"), F.lit(order).alias("ord"), (p["start"] + e["b"]).alias("stop"),
        F.lit(kind).alias("kind")))))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def with_spans(docs: DataFrame, base: str = "base_spans", spans: str = "secret_spans") -> DataFrame:
    """``docs`` with two array columns: base spans, and all spans in order
    (start, ord, stop, kind).  Null text has none; other columns stay."""
    text = F.coalesce(docs["text"], F.lit(""))
    kept = [docs[c] for c in docs.columns]
    hits = [f"_hits_{i}" + "_" * max(map(len, docs.columns)) for i in range(4)]     # no name of that length is taken
    found = docs.select(*kept, *[matches(text, p).alias(h) for p, h in zip((ASSIGN, ACCESS, HEX, TOKEN), hits)])
    text = F.coalesce(found["text"], F.lit(""))
    found = found.withColumn(base, base_spans(text, *[found[h] for h in hits[:3]]))
    # token runs count only where the allow list does not know them all
    tokens = F.when(F.exists(found[hits[3]], lambda t: ~t.rlike(_ALLOWED)), found[hits[3]]).otherwise(F.array().cast("array<string>"))
    all_spans = F.array_sort(F.concat(found[base], entropy_spans(text, tokens, found[base])))
    return found.select(*[found[c] for c in docs.columns], found[base], all_spans.alias(spans))


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per document (repeated rows each): doc_id, n_assign, n_access,
    n_hex, base_sha256 and spans, places in code points."""
    found = with_spans(docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text")))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"),
                        _joined(F.col("secret_spans")).alias("spans"))


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced by MASK (overlapping spans by
    one); n_chars follows the text; documents without secrets, and null
    texts, stay as they are.  No row is dropped."""
    base, spans = "_base_spans", "_secret_spans"
    while base in docs.columns or spans in docs.columns:
        base, spans = base + "_", spans + "_"
    found = with_spans(docs, base, spans)
    text = found["text"]
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, s):
        before = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"),
                        F.when(s["start"] < state["at"], state["out"])
                        .otherwise(F.concat(state["out"], before, F.lit(MASK))).alias("out"))

    masked = F.aggregate(found[spans], first, step, lambda s: F.concat(
        s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    changed = F.size(found[spans]) > 0
    new_text = F.when(changed, masked).otherwise(text)
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(new_text.alias("text"))
        elif c == "n_chars":
            out.append(F.when(changed, F.length(masked).cast("long")).otherwise(found["n_chars"]).alias("n_chars"))
        else:
            out.append(found[c])
    return found.select(*out)
