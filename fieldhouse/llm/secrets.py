"""Secrets in texts: fixed patterns, and a battery of randomness tests under false-discovery control.

Everything is column expressions. A match's place comes from splitting the text at the same pattern: it starts after the
parts and matches before it, in code points.

Besides the patterns, every token of TOKEN characters or more is tested. Its encoding is inferred from its characters,
its symbols are numbered in that alphabet, and three statistics are taken: chi-squared of the symbol counts against a
uniform alphabet, the number of runs above and below the alphabet's middle, and the correlation of neighbours. Fisher's
method combines the three p-values of randomness; a token that looks random (over LOOKS_RANDOM) is then tested against
written text, whose symbol counts are at least WRITTEN[encoding] from uniform: the p-value is the chance that the
noncentral chi-squared statistic of such a text of that length is as small as the token's. Short tokens prove little
and get large p-values. Benjamini-Hochberg is applied to all tokens of the corpus per length class, on counts of p-values
in steps of a quarter decade, so the driver sees one small number per class and step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
VALUE = 12
"""Fixed values: the patterns of the base kinds, and the least characters of an assigned value."""
KINDS = ("assign", "access", "hex", "random")

TOKEN = 20
CANDIDATE = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{TOKEN},}}={{0,2}}"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = [
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 0.5),
    ("base32", "^[A-Z2-7]+$", LETTERS.upper() + "234567", 0.8),
    ("lower", "^[a-z]+$", LETTERS, 0.65),
    ("base36", "^[a-z0-9]+$", LETTERS + "0123456789", 1.0),
    ("alnum", "^[A-Za-z0-9]+$", LETTERS.upper() + LETTERS + "0123456789", 2.0),
    ("base64", ".", LETTERS.upper() + LETTERS + "0123456789+/", 2.0)]
"""Name, pattern, alphabet, and how far written text is from uniform there at least (chi-squared per symbol)."""
LOOKS_RANDOM, FALSE_SHARE = 0.01, 0.01
LENGTHS = (32, 64, 128)
"""Where the classes of token lengths end."""
STEP, STEPS = 4, 80
MASK = "[secret]"


def matches(text: str, pattern: str) -> Column:
    return F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))


def placed(text: str, found: Column, pattern: str, size: Column | None = None) -> Column:
    """Array of (start, end, match) of the matches `found` of a pattern; null where there is none."""
    parts = F.split(F.col(text), pattern, -1)
    at = lambda a, i: F.element_at(a, i + 1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["part"])
        e = s + F.length(x["match"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("start"), e.alias("end"), x["match"].alias("match")))).alias("out"))

    pairs = F.transform(found, lambda m, i: F.struct(at(parts, i).alias("part"), m.alias("match")))
    return F.when(F.size(found) > 0, F.aggregate(pairs, start, step, lambda acc: acc["out"]))


def with_base(docs: DataFrame, text: str) -> DataFrame:
    """Adds `_base`, the array of (start, kind, end) of the fixed patterns; kind as a number."""
    kinds = ((ASSIGN, "_assign"), (ACCESS, "_access"), (HEX, "_hex"))
    docs = docs.withColumns({c: matches(text, p) for p, c in kinds})
    docs = docs.withColumns({f"{c}_at": placed(text, F.col(c), p) for p, c in kinds})
    # a match that fails still takes its characters, so values are measured afterwards
    long_value = F.filter(F.col("_assign_at"), lambda m: F.length(F.regexp_extract(m["match"], ASSIGN, 2)) >= VALUE)
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def spans(found: Column, kind: int) -> Column:
        return F.transform(F.coalesce(found, none), lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))

    every = (long_value, F.col("_access_at"), F.col("_hex_at"))
    return docs.withColumn("_base", F.concat(*[spans(found, k) for k, found in enumerate(every)])).drop(*[c for _, c in kinds], *[f"{c}_at" for _, c in kinds])


def normal(z: Column) -> Column:
    """Distribution function of the normal, by a logistic curve with a cubic term."""
    return 1 / (1 + F.exp(-F.greatest(F.least(1.5976 * z + 0.07056 * z * z * z, F.lit(300.0)), F.lit(-300.0))))


def tested(found: Column) -> Column:
    """Array of (start, end, class of length, p) of the tokens placed in `found`."""
    body = lambda t: F.regexp_replace(t["match"], "=+$", "")

    def encoding(t: Column) -> Column:
        kind = F.lit(len(ENCODINGS) - 1)
        for k in range(len(ENCODINGS) - 2, -1, -1):
            kind = F.when(body(t).rlike(ENCODINGS[k][1]), k).otherwise(kind)
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), body(t).alias("body"), kind.alias("kind"))

    def choice(values: list, kind: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), kind + 1)

    def numbered(t: Column) -> Column:
        alphabet = choice([a for _, _, a, _ in ENCODINGS], t["kind"])
        plain = F.when(t["kind"] == 0, F.lower(t["body"])).otherwise(F.translate(t["body"], "-_", "+/"))
        codes = F.transform(F.split(plain, ""), lambda c: F.instr(alphabet, c) - 1)
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), t["body"].alias("body"), plain.alias("plain"), alphabet.alias("alphabet"),
                        F.length(plain).cast("double").alias("n"), F.length(alphabet).cast("double").alias("k"),
                        choice([w for _, _, _, w in ENCODINGS], t["kind"]).alias("w"), codes.alias("codes"))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)

    def sums(t: Column) -> Column:
        codes, n = t["codes"], t["n"]
        squares = total(F.transform(F.split(t["alphabet"], ""), lambda c: F.pow(n - F.length(F.replace(t["plain"], c, F.lit(""))), F.lit(2.0))))
        mean = total(F.transform(codes, lambda c: c.cast("double"))) / n
        near = F.arrays_zip(F.slice(codes, F.lit(1), F.size(codes) - 1).alias("a"), F.slice(codes, F.lit(2), F.size(codes) - 1).alias("b"))
        high = lambda c: c * 2 >= t["k"]
        return F.struct(
            *[t[c].alias(c) for c in ("start", "end", "body", "n", "k", "w")], (squares * t["k"] / n - n).alias("chi"),
            total(F.transform(codes, lambda c: F.when(high(c), 1.0).otherwise(0.0))).alias("high"),
            (total(F.transform(near, lambda x: F.when(high(x["a"]) != high(x["b"]), 1.0).otherwise(0.0))) + 1).alias("runs"),
            total(F.transform(codes, lambda c: (c - mean) * (c - mean))).alias("spread"),
            total(F.transform(near, lambda x: (x["a"] - mean) * (x["b"] - mean))).alias("lag"))

    def scores(t: Column) -> Column:
        n, df = t["n"], t["k"] - 1
        both = 2 * t["high"] * (n - t["high"])
        runs = F.when(both > n, (t["runs"] - 1 - both / n) / F.sqrt(both * (both - n) / (n * n * (n - 1)))).otherwise(9.0)
        serial = F.when(t["spread"] > 0, (t["lag"] / t["spread"] + 1 / n) * F.sqrt(n)).otherwise(9.0)
        uniform = (F.pow(t["chi"] / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))  # Wilson and Hilferty
        beyond = n * t["w"]
        written = normal((t["chi"] - df - beyond) / F.sqrt(2 * (df + 2 * beyond)))
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), t["body"].alias("body"), n.alias("n"), uniform.alias("u"),
                        runs.alias("r"), serial.alias("s"), written.alias("written"))

    def verdict(t: Column) -> Column:
        log = lambda p: F.log(F.greatest(p, F.lit(1e-300)))
        x = -(log(1 - normal(t["u"])) + log(2 - 2 * normal(F.abs(t["r"]))) + log(2 - 2 * normal(F.abs(t["s"]))))
        fisher = F.exp(-x) * (1 + x + x * x / 2)  # chi-squared of 6 degrees, beyond 2x
        number = t["body"].rlike("^[0-9]+$")
        p = F.when(number | (fisher < LOOKS_RANDOM), 1.0).otherwise(t["written"])
        size = sum([(t["n"] >= b).cast("int") for b in LENGTHS], F.lit(0))
        step = F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * STEP), F.lit(STEPS)).cast("int")
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), size.alias("size"), step.alias("step"))

    for stage in (encoding, numbered, sums, scores, verdict):
        found = F.transform(found, stage)
    return found


def with_tokens(docs: DataFrame, text: str) -> DataFrame:
    """Adds `_tokens`, the tested tokens, null where there is none."""
    docs = docs.withColumn("_found", matches(text, CANDIDATE)).withColumn("_found", placed(text, F.col("_found"), CANDIDATE))
    return docs.withColumn("_tokens", tested(F.col("_found"))).drop("_found")


def discovery_steps(docs: DataFrame, text: str) -> list[int]:
    """Per class of lengths, the first step of p whose tokens are discoveries (STEPS + 1: none), over all rows."""
    tokens = with_tokens(docs.select(text), text).select(F.explode("_tokens").alias("t")).groupBy("t.size", "t.step").agg(F.count("*").alias("n"))
    table = [[0] * (STEPS + 1) for _ in range(len(LENGTHS) + 1)]
    for r in tokens.collect():  # classes times steps, a bounded number of rows
        table[r["size"]][r["step"]] += r["n"]
    out = []
    for counts in table:
        tests, found, first = sum(counts), 0, STEPS + 1
        for step in range(STEPS, -1, -1):
            found += counts[step]
            if found and tests * 10 ** (-step / STEP) / found <= FALSE_SHARE:
                first = step
        out.append(first)
    return out


def _text(spans: Column) -> Column:
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string"))))


def with_secrets(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: row (all its columns, as a struct), base and spans: sorted arrays of (start, kind, end).

    `base` has the matches of the patterns, `spans` also the discovered tokens that overlap none of them. kind is the
    place in KINDS; start and end count code points. Null and empty texts have no spans. Repeated rows get equal spans;
    an empty table gives an empty result. Columns besides text are carried unread, whatever their names.
    """
    rows = docs.select(F.coalesce("text", F.lit("")).alias("_text"), F.struct(*docs.columns).alias("row"))
    first = discovery_steps(rows, "_text")
    rows = with_tokens(with_base(rows, "_text"), "_text")
    least = F.array(*map(F.lit, first))
    none = F.array().cast("array<struct<start:int,end:int,size:int,step:int>>")
    hits = F.filter(F.coalesce("_tokens", none), lambda t: (t["step"] >= F.element_at(least, t["size"] + 1)) & ~F.exists(
        F.col("_base"), lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    more = F.transform(hits, lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end")))
    return rows.select("row", F.array_sort("_base").alias("base"), F.array_sort(F.concat("_base", more)).alias("spans"))


def reported(found: DataFrame) -> DataFrame:
    """(row, n_assign, n_access, n_hex, base_sha256, spans) with spans as text."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("row", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, overlapping ones together, replaced by MASK."""
    kind = "struct<start:int,end:int>"

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        one = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(F.size(acc) == 0, F.array(one)).when(
            s["start"] < last["end"], F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(grown))).otherwise(F.concat(acc, F.array(one)))

    def rebuilt(m: Column) -> Column:
        begin = lambda i: F.when(i == 0, 0).otherwise(F.get(m, i - 1)["end"])
        end = lambda i: F.coalesce(F.get(m, i)["start"], F.length(text))
        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(m)), lambda i: F.substring(text, begin(i) + 1, end(i) - begin(i))), MASK)

    merged = F.aggregate(spans, F.array().cast(f"array<{kind}>"), merge)
    return F.when(F.size(spans) > 0, F.element_at(F.transform(F.array(merged), rebuilt), 1)).otherwise(text)
