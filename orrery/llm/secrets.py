"""Operator 3: secret scans with a randomness test battery (DataFrame functions only).

Base spans come from three fixed patterns.  The battery adds spans of kind
`random`: runs of 20 or more token characters that overlap no base span.  From
its characters a token's encoding is inferred, hence its alphabet of k letters;
over that alphabet three tests are made:

* chi-squared uniformity of the letters,
* a runs test on the upper and lower half of the alphabet,
* lag-one serial correlation of letter numbers.

The null hypothesis is ordinary text.  Its letters coincide as often as in
European languages, so its chi-squared statistic is larger than that of a random
token; and text is no more regular than chance in the other two, so 1 - z^2 of
each has a mean of 0 at most.  The three add up (CHI_WEIGHT against the others)
to one normal deviate, large for tokens that look random to all tests; a runs or
correlation value far from chance pulls it down.  Of a token that holds letters
of a hexadecimal alphabet alone, the chance that text does so counts too.  This
combined p-value goes through the Benjamini-Hochberg procedure over all tokens of
the corpus at rate `fdr`, separately for each length band, since short tokens
carry little evidence.  The procedure runs on counts of binned p-values (BINS a
factor of ten, rounded to the cautious side), so what it gathers has a fixed
size.  A token also must not be ruled out as random: three times the smallest of
its three p-values against randomness is at least `alpha`.

Texts are matched once; spans and p-values are written, and judged from there.
Work grows in proportion to a text's matches (times a block of BLOCK matches).

Positions count code points.  Defined cases: a NULL text is empty and has no
spans; repeated rows get repeated results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import materialize

#: The base patterns, and the least length of what they capture.
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
BASE = [("assign", ASSIGN, 2, 12), ("access", ACCESS, 0, 18), ("hex", r"[0-9a-f]{16,}", 0, 16)]
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
#: Encodings by the characters that they allow, narrowest first.
ENCODINGS = [
    ("decimal", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("hex_upper", "0123456789ABCDEF"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("mixed", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
]
KINDS = ["assign", "access", "hex", "random"]
BINS, TOP_BIN = 20, 400
#: How often two letters of European text coincide; the share of A to F among its letters.
COINCIDENCE, SHARE_A_TO_F = 0.065, 1 / 3
#: Weight of the chi-squared test against either of the other two.
CHI_WEIGHT = 4.0
#: Array elements that one step of a scan handles.
BLOCK = 256


def let(value: Column, use) -> Column:
    """use(value), the value being computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def blocks(items: Column) -> Column:
    """The array cut into arrays of BLOCK elements; an empty one has none."""
    cut = lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK)))
    return let(items, lambda v: F.when(F.size(v) > 0, cut(v)).otherwise(F.array()))


def scan(items: Column, kind: str, first: Column, step) -> Column:
    """Running states: step(state before, item) for each item; `kind` is the state's type.  By blocks, since appending to
    an array copies it."""
    none = F.array().cast(f"array<{kind}>")

    def inner(before: Column, block: Column) -> Column:
        return F.aggregate(block, none, lambda part, x: F.concat(part, F.array(step(F.coalesce(F.try_element_at(part, F.lit(-1)), before), x).cast(kind))))

    def outer(done: Column, block: Column) -> Column:
        return F.concat(done, F.array(inner(F.coalesce(F.try_element_at(F.try_element_at(done, F.lit(-1)), F.lit(-1)), first.cast(kind)), block)))

    return F.flatten(F.aggregate(blocks(items), F.array().cast(f"array<array<{kind}>>"), outer))


_MATCH = "struct<start:int,end:int,m:string>"


def matches(text: Column, pattern: str, keep=None) -> Column:
    """array<struct<start, end, m>> of all leftmost matches that `keep` accepts; computed only where there is one."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    steps = F.zip_with(F.split(text, pattern, -1), found, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("m")))
    steps = F.filter(steps, lambda s: s["m"].isNotNull())
    at = lambda p, s: F.struct((p["end"] + s["gap"]).alias("start"), (p["end"] + s["gap"] + F.length(s["m"])).alias("end"), s["m"].alias("m"))
    walked = scan(steps, _MATCH, F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("m")), at)
    return F.when(text.rlike(pattern), F.filter(walked, lambda s: keep(s["m"])) if keep else walked).otherwise(F.array().cast(f"array<{_MATCH}>"))


def base_spans(text: Column) -> list[Column]:
    return [matches(text, pattern, lambda m, p=pattern, g=group, n=least: F.length(F.regexp_extract(m, p, g)) >= n) for _, pattern, group, least in BASE]


def free_tokens(tokens: Column, base: Column) -> Column:
    """The tokens (disjoint, array of matches) that overlap no base span: sorted together, a token must end before the
    next base span starts and start after all earlier ones have ended."""
    mark = lambda c, own: F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(own).alias("own"), s["m"].alias("m")))
    every = F.array_sort(F.concat(mark(base, False), mark(tokens, True)))
    far = 2**31 - 1

    def judge(v: Column) -> Column:
        high = scan(v, "struct<at:int>", F.struct(F.lit(0).alias("at")), lambda p, s: F.struct(F.when(s["own"], p["at"]).otherwise(F.greatest(p["at"], s["end"])).alias("at")))
        low = scan(F.reverse(v), "struct<at:int>", F.struct(F.lit(far).alias("at")), lambda p, s: F.struct(F.when(s["own"], p["at"]).otherwise(s["start"]).alias("at")))
        three = F.zip_with(F.zip_with(v, high, lambda s, h: F.struct(s.alias("s"), h["at"].alias("high"))), F.reverse(low), lambda s, low: F.struct(s["s"].alias("s"), s["high"].alias("high"), low["at"].alias("low")))
        fine = F.filter(three, lambda t: t["s"]["own"] & (t["high"] <= t["s"]["start"]) & (t["low"] >= t["s"]["end"]))
        return F.transform(fine, lambda t: F.struct(t["s"]["start"].alias("start"), t["s"]["end"].alias("end"), t["s"]["m"].alias("m")))

    return F.when((F.size(tokens) > 0) & (F.size(base) > 0), let(every, judge)).otherwise(tokens)


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal distribution, by a rational approximation good in both tails."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    q = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, q).otherwise(1 - q)


def _chi_squared(token: Column, k: Column) -> Column:
    letters = F.array_distinct(F.split(token, ""))
    squares = F.aggregate(letters, F.lit(0.0), lambda a, c: a + F.pow((F.length(token) - F.length(F.replace(token, c, F.lit("")))).cast("double"), 2))
    n = F.length(token)
    return F.greatest(F.lit(0.0), k / n * squares - n)


def _alphabet(token: Column) -> Column:
    expr = F.lit(ENCODINGS[-1][1])
    for _, letters in reversed(ENCODINGS[:-1]):
        expr = F.when(F.length(F.translate(token, letters, "")) == 0, F.lit(letters)).otherwise(expr)
    return expr


def _length_band(n: Column) -> Column:
    return F.least(F.lit(10), F.floor(F.log2(n.cast("double"))).cast("int"))


def _bin(p: Column) -> Column:
    return F.least(F.lit(TOP_BIN), F.floor(-BINS * F.log10(F.greatest(p, F.lit(1e-30))))).cast("int")


def battery(token: Column) -> Column:
    """struct<band, bin, p_random, p_text> of a token: length band, bin of p_text, and the combined p-values of the three
    tests against randomness and against text.  One expression, so it also serves inside array functions."""
    body = F.rtrim(token, F.lit("="))
    n = F.length(body)
    alphabet = _alphabet(body)
    one = F.array(F.struct(body.alias("body"), alphabet.alias("alphabet"), F.length(alphabet).cast("double").alias("k"), n.alias("n")))

    def test(s: Column) -> Column:
        k, n, df = s["k"], s["n"], s["k"] - 1
        chi = _chi_squared(s["body"], k)
        x = F.transform(F.split(s["body"], ""), lambda c: (F.instr(s["alphabet"], c) - 1).cast("double"))
        return F.struct(s["body"].alias("body"), k.alias("k"), n.alias("n"), df.alias("df"), chi.alias("chi"), x.alias("x"), F.length(F.translate(s["body"], "0123456789", "")).alias("letters"), (F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / n).alias("mean"))

    def sums(s: Column) -> Column:
        pairs = F.zip_with(F.slice(s["x"], F.lit(1), s["n"] - 1), F.slice(s["x"], F.lit(2), s["n"] - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        middle = s["k"] / 2
        return F.struct(
            s["k"].alias("k"), s["n"].alias("n"), s["df"].alias("df"), s["chi"].alias("chi"), s["letters"].alias("letters"),
            F.aggregate(s["x"], F.lit(0.0), lambda a, v: a + F.when(v >= middle, 1.0).otherwise(0.0)).alias("n1"),
            F.aggregate(pairs, F.lit(1.0), lambda a, p: a + F.when((p["a"] >= middle) != (p["b"] >= middle), 1.0).otherwise(0.0)).alias("runs"),
            F.aggregate(s["x"], F.lit(0.0), lambda a, v: a + F.pow(v - s["mean"], 2)).alias("spread"),
            F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - s["mean"]) * (p["b"] - s["mean"])).alias("product"),
        )

    def verdict(s: Column) -> Column:
        n, n1, df, k = s["n"], s["n1"], s["df"], s["k"]
        n2 = n - n1
        wilson = (F.pow(s["chi"] / df, 1 / 3) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        variance = 2 * n1 * n2 * (2 * n1 * n2 - n) / (n.cast("double") * n * (n - 1))
        z_runs = F.coalesce(F.when(variance > 0, (s["runs"] - 2 * n1 * n2 / n - 1) / F.sqrt(variance)), F.lit(99.0))
        z_serial = F.coalesce(F.when(s["spread"] > 0, (s["product"] / s["spread"] + 1 / n) * F.sqrt(n.cast("double"))), F.lit(99.0))
        least = F.least(upper_tail(wilson), 2 * upper_tail(F.abs(z_runs)), 2 * upper_tail(F.abs(z_serial)))
        shift = n * (F.greatest(F.lit(COINCIDENCE), 1.2 / k) * k - 1)
        z_chi = -(s["chi"] - df - shift) / F.sqrt(2 * df + 4 * shift)
        regular = (2 - z_runs * z_runs - z_serial * z_serial) / 2**0.5
        p_text = upper_tail((CHI_WEIGHT * z_chi + regular) / (CHI_WEIGHT**2 + 2) ** 0.5) * F.when(k == 16, F.pow(F.lit(SHARE_A_TO_F), s["letters"])).otherwise(1.0)
        return F.struct(_length_band(n).alias("band"), _bin(p_text).alias("bin"), F.least(F.lit(1.0), 3 * least).alias("p_random"), p_text.alias("p_text"))

    return F.element_at(F.transform(F.transform(F.transform(one, test), sums), verdict), 1)


def _located(docs: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` columns, base spans by kind (b0, b1, b2) and candidate tokens (array c of start, end and verdict)."""
    named = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.coalesce("text", F.lit("")).alias("_t"))
    spans = [F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("").alias("m"))).alias(f"b{i}") for i, c in enumerate(base_spans(F.col("_t")))]
    ks = [f"k{i}" for i in range(len(keep))]
    d = named.select(*ks, *spans, matches(F.col("_t"), TOKEN).alias("c"))
    d = d.select(*ks, "b0", "b1", "b2", free_tokens(F.col("c"), F.concat("b0", "b1", "b2")).alias("c"))
    judged = F.transform("c", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), battery(t["m"]).alias("p")))
    bare = lambda c: F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(c)
    return d.select(*ks, bare("b0"), bare("b1"), bare("b2"), judged.alias("c"))


def discovery_bins(tested: DataFrame, fdr: float) -> dict[int, int]:
    """Per length band the lowest bin of p-values that the Benjamini-Hochberg procedure accepts; at most 11 rows."""
    count = tested.groupBy("band", "bin").agg(F.count("*").alias("n"))
    down = Window.partitionBy("band").orderBy(F.col("bin").desc())
    got = count.withColumn("at", F.sum("n").over(down)).withColumn("m", F.sum("n").over(Window.partitionBy("band")))
    ok = got.where(F.pow(F.lit(10.0), -F.col("bin") / BINS) <= fdr * F.col("at") / F.col("m"))
    return {r["band"]: r["bin"] for r in ok.groupBy("band").agg(F.min("bin").alias("bin")).collect()}


def scan_secrets(docs: DataFrame, keep: list[str] | None = None, alpha: float = 0.001, fdr: float = 0.05) -> DataFrame:
    """`keep` columns (default doc_id), n_assign, n_access, n_hex, n_random, base_sha256, spans, and
    `found` (array<struct<start, kind, end>>, sorted) for every row of `docs`."""
    keep = keep or ["doc_id"]
    located = materialize(_located(docs, keep), "located")
    tested = located.where(F.size("c") > 0).select(F.explode("c.p").alias("p")).select("p.band", "p.bin")
    lowest = discovery_bins(tested, fdr)
    never = F.lit(TOP_BIN + 1)
    limit = F.create_map(*[F.lit(x) for b, v in lowest.items() for x in (b, v)]) if lowest else F.create_map(F.lit(-1), never)

    def secret(t: Column) -> Column:
        return (t["p"]["p_random"] >= alpha) & (t["p"]["bin"] >= F.coalesce(F.element_at(limit, t["p"]["band"]), never))

    judged = located.withColumn("c", F.filter("c", secret))

    def of_kind(c: str, kind: int) -> Column:
        return F.transform(c, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    plain = [of_kind(c, kind) for kind, c in enumerate(("b0", "b1", "b2", "c"))]
    base = F.array_sort(F.concat(*plain[:3]))
    every = F.array_sort(F.concat(*plain))
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    return judged.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[F.size(c).cast("long").alias(n) for c, n in (("b0", "n_assign"), ("b1", "n_access"), ("b2", "n_hex"), ("c", "n_random"))],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(every).alias("spans"), every.alias("found"),
    )


def cut_spans(text: Column, spans: Column, mark: str) -> Column:
    """The text with its spans (array<struct<start, kind, end>>, sorted, not empty) replaced by `mark`, overlapping ones
    by one.  Pieces are cut from a block's part of the text, since finding a code point takes a walk over the text."""
    state = "struct<at:int,start:int,end:int>"
    step = lambda p, s: F.struct(p["end"].alias("at"), s["start"].alias("start"), F.greatest(p["end"], s["end"]).alias("end"))
    runs = scan(spans, state, F.struct(F.lit(0).alias("at"), F.lit(0).alias("start"), F.lit(0).alias("end")), step)

    def block(b: Column) -> Column:
        low = b[0]["at"]
        part = F.struct(b.alias("b"), low.alias("low"), F.substring(text, low + 1, F.element_at(b, -1)["start"] - low).alias("part"))
        return let(part, lambda u: F.transform(u["b"], lambda s: F.concat(F.substring(u["part"], s["at"] - u["low"] + 1, s["start"] - s["at"]), F.lit(mark))))

    def whole(v: Column) -> Column:
        fresh = F.filter(v, lambda s: (s["start"] >= s["at"]))
        return F.concat(F.array_join(F.flatten(F.transform(blocks(fresh), block)), ""), F.substring(text, F.element_at(v, -1)["end"] + 1, F.length(text)))

    return let(runs, whole)


def redact(docs: DataFrame, mark: str = "[SECRET]", alpha: float = 0.001, fdr: float = 0.05) -> DataFrame:
    """The rows of `docs`, with all their columns: each secret in `text` is replaced by `mark` (overlapping ones by
    one mark), and `n_chars`, if there, is the new length where the text changed."""
    names = docs.columns
    plain = docs.select(*[F.col(c).alias(f"col_{i}") for i, c in enumerate(names)], "text")
    got = scan_secrets(plain, [f"col_{i}" for i in range(len(names))], alpha, fdr)
    text = F.col(f"col_{names.index('text')}")
    changed = F.size("found") > 0
    got = got.withColumn("cut", F.when(changed, cut_spans(text, F.col("found"), mark)).otherwise(text))
    out = {"text": F.col("cut"), "n_chars": F.when(changed, F.length("cut").cast("long")).otherwise(F.col(f"col_{names.index('n_chars')}") if "n_chars" in names else F.lit(None))}
    return got.select(*[out.get(c, F.col(f"col_{i}")).alias(c) for i, c in enumerate(names)])


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("found")
