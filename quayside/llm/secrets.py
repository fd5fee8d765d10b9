"""Secret scan in DataFrame and SQL functions alone: key patterns, and a battery of randomness tests on long tokens.

Positions come from marking: every match is wrapped in two private-use characters by regexp_replace, the text is split at
the first of them, and lengths of the pieces add up to code-point offsets. The two characters are replaced one for one in
the text beforehand, so lengths and matches stay the same.

Randomness tests. A token of 20 or more characters gets an encoding from its characters (hex, base32, alphabetic,
alphanumeric, base64). Three statistics are taken: chi-squared of its character counts against a uniform alphabet, runs
of character classes, and serial correlation of neighbouring characters. Each is standardised against uniform randomness;
the sum of the squares of the three must not contradict it. What remains is tested against ordinary text, in which counts
are uneven (chi-squared is noncentral and grows with the length) and neighbours mostly of one class: both deviations are
combined into one p-value, the chance that ordinary text of this length looks so random. What ordinary text is like is
estimated from all tokens of the table that do contradict randomness. Benjamini-Hochberg over all tokens of an encoding
then bounds the share of ordinary tokens among the finds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.session import cut

OPEN, MID, CLOSE, OTHER = "", "", "", "�"
# The base patterns, in the order of their kinds.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
#: A run of such characters fails by its length as a whole, so the length may stand in the pattern.
ACCESS = r"(AKIA[A-Z0-9]{16,})()"
HEX = r"([0-9a-f]{24,})()"
TOKEN = r"([A-Za-z0-9+/_=-]{20,})()"
MIN_VALUE = 6
MIN_TOKEN = 20

#: Encoding: pattern, alphabet, share of equal classes of neighbours if random; prior noncentrality a character and share of
#: neighbours of unlike classes of ordinary text (null: classes say nothing).
ENCODINGS = {
    "hex": ("^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 0.53125, 1.5, 0.15),
    "alpha": ("^[A-Za-z][a-z]*$|^[A-Z]+$", "abcdefghijklmnopqrstuvwxyz", 0.5, 0.75, None),
    "base32": ("^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.6953, 1.3, 0.1),
    "alnum": ("^[A-Za-z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 0.3777, 3.0, 0.15),
    "base64": ("^[A-Za-z0-9+/_=-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.3555, 3.1, 0.33),
}
#: The sum of the three squares that randomness exceeds once in a thousand tokens (chi-squared with 3 degrees of freedom).
CONTRADICTS = 16.27
#: Characters that the priors count for.
PRIOR = 20_000.0
FALSE_DISCOVERIES = 0.01
BIN = 0.05


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pieces(text: str, pattern: str) -> str:
    marked = f"regexp_replace({text}, {_lit(pattern)}, '{OPEN}$1{MID}$2{CLOSE}')"
    return f"split({marked}, '{OPEN}')"


def _located(pieces: str, body: str, kind: int) -> str:
    """SQL for the spans of all matches in an array of pieces. Each piece but the first is head MID tail CLOSE rest."""
    return f"""CASE WHEN size({pieces}) < 2 THEN cast(array() AS array<struct<start:int,kind:int,end:int,body:string,value:int>>) ELSE
      aggregate(slice({pieces}, 2, size({pieces}) - 1),
        named_struct('at', length({pieces}[0]), 'found', cast(array() AS array<struct<start:int,kind:int,end:int,body:string,value:int>>)),
        (a, p) -> named_struct(
          'at', a.at + length(p) - 2,
          'found', array_append(a.found, named_struct('start', a.at, 'kind', {kind}, 'end', a.at + instr(p, '{CLOSE}') - 2,
            'body', {body}, 'value', instr(p, '{CLOSE}') - instr(p, '{MID}') - 1))),
        a -> a.found) END"""


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, base, tokens): row holds all columns of docs as a struct, so that no name can clash; base are the spans of the
    base patterns, tokens those of candidate tokens outside of them, with their test statistics."""
    d = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), F.translate(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), OPEN + MID + CLOSE, OTHER * 3).alias("t"))
    for i, pattern in enumerate((ASSIGN, ACCESS, HEX, TOKEN)):
        d = d.withColumn(f"p{i}", F.expr(_pieces("t", pattern)))
    none, token = "cast(NULL AS string)", f"substring(p, 1, instr(p, '{MID}') - 1)"
    d = d.select(
        "row",
        F.expr(f"filter({_located('p0', none, 0)}, x -> x.value >= {MIN_VALUE})").alias("s0"),
        *(F.expr(_located(f"p{i}", token if i == 3 else none, i)).alias(f"s{i}") for i in (1, 2, 3)),
    )
    return d.select(
        "row",
        F.expr("array_sort(transform(concat(s0, s1, s2), x -> struct(x.start, x.kind, x.end)))").alias("base"),
        F.expr("filter(s3, x -> NOT exists(concat(s0, s1, s2), y -> y.start < x.end AND x.start < y.end))").alias("s3"),
    ).select("row", "base", F.expr(f"transform(s3, x -> {_tested('x')})").alias("tokens"))


def _tested(x: str) -> str:
    """SQL for struct(start, end, enc, n, excess, unlike, ok): chi-squared above its expectation, neighbours of unlike classes, and
    whether randomness is not contradicted; ok is null for tokens that are not tested (too short without padding, digits)."""
    body = f"rtrim('=', {x}.body)"
    enc = "CASE " + " ".join(f"WHEN {x}.body RLIKE {_lit(p)} THEN '{k}'" for k, (p, *_) in ENCODINGS.items()) + " END"
    by = lambda i: "CASE e.enc " + " ".join(f"WHEN '{k}' THEN {v[i] if i > 1 else _lit(v[1])}" for k, v in ENCODINGS.items()) + " END"
    # Nested one-row arrays name intermediate results, so each is computed once a token.
    first = f"array(named_struct('s', CASE {enc} WHEN 'hex' THEN lower({body}) WHEN 'alpha' THEN lower({body}) ELSE translate({body}, '-_', '+/') END, 'enc', {enc}))"
    classes = (
        "CASE e.enc WHEN 'alpha' THEN regexp_replace(regexp_replace(e.s, '[a-m]', 'A'), '[n-z]', 'B') "
        "ELSE regexp_replace(regexp_replace(regexp_replace(regexp_replace(e.s, '[a-z]', 'l'), '[A-Z]', 'U'), '[0-9]', '0'), '[^lU0]', '#') END"
    )
    second = f"""transform({first}, e -> named_struct('enc', e.enc, 'n', cast(length(e.s) AS double), 'k', cast(length({by(1)}) AS double),
        'same', cast({by(2)} AS double), 'digits', e.s RLIKE '^[0-9]*$',
        'squares', aggregate(array_distinct(split(e.s, '')), 0D, (a, c) -> a + power(length(e.s) - length(replace(e.s, c, '')), 2)),
        'runs', cast(length(regexp_replace({classes}, '(.)\\\\1*', 'x')) AS double),
        'o', transform(split(e.s, ''), c -> cast(instr({by(1)}, c) AS double))))"""
    third = f"""transform({second}, f -> named_struct('f', f, 'x2', f.k / f.n * f.squares - f.n, 'm', aggregate(f.o, 0D, (a, v) -> a + v) / f.n))"""
    serial = """aggregate(zip_with(slice(g.f.o, 1, size(g.f.o) - 1), slice(g.f.o, 2, size(g.f.o) - 1), (u, v) -> (u - g.m) * (v - g.m)), 0D, (a, v) -> a + v)
        / nullif(aggregate(g.f.o, 0D, (a, v) -> a + (v - g.m) * (v - g.m)), 0D) * sqrt(g.f.n)"""
    runs = "(g.f.runs - 1 - (1 - g.f.same) * (g.f.n - 1)) / sqrt(g.f.same * (1 - g.f.same) * (g.f.n - 1))"
    even = "greatest((pow(greatest(g.x2, 0D) / (g.f.k - 1), 1D / 3) - (1 - 2D / (9 * (g.f.k - 1)))) / sqrt(2D / (9 * (g.f.k - 1))), 0D)"
    against = f"power({runs}, 2) + power(coalesce({serial}, 9D), 2) + power({even}, 2)"
    ok = f"CASE WHEN g.f.n >= {MIN_TOKEN} AND NOT g.f.digits THEN {against} <= {CONTRADICTS} END"
    return f"""transform({third}, g -> named_struct('start', {x}.start, 'end', {x}.end, 'enc', g.f.enc, 'n', g.f.n, 'excess', g.x2 - (g.f.k - 1),
        'unlike', g.f.runs - 1, 'ok', {ok}))[0]"""


def ordinary(scanned: DataFrame) -> dict[str, tuple[float, float | None]]:
    """Per encoding, noncentrality a character and share of unlike neighbours of ordinary text: the means over all tokens of the
    table that contradict randomness, together with PRIOR characters of the prior."""
    seen = {
        r.enc: r
        for r in scanned.select(F.explode("tokens").alias("t")).filter("NOT t.ok").groupBy("t.enc")
        .agg(F.sum("t.excess").alias("x"), F.sum("t.unlike").alias("u"), F.sum("t.n").alias("n"), F.sum(F.col("t.n") - 1).alias("pairs")).collect()
    }
    out = {}
    for k, (_, _, same, lam, unlike) in ENCODINGS.items():
        x, u, n, pairs = (seen[k].x, seen[k].u, seen[k].n, seen[k].pairs) if k in seen else (0.0, 0.0, 0.0, 0.0)
        mean = max((x + PRIOR * lam) / (n + PRIOR), 0.1)
        out[k] = mean, None if unlike is None else min((u + PRIOR * unlike) / (pairs + PRIOR), 0.9 * (1 - same))
    return out


def _z(x: str, kinds: dict[str, tuple[float, float | None]]) -> str:
    """SQL for the standardised randomness of a token against ordinary text, lower for more random; null unless ok."""
    cases = []
    for k, (lam, unlike) in kinds.items():
        free = len(ENCODINGS[k][1]) - 1
        z = f"({x}.excess - {x}.n * {lam!r}D) / sqrt({2 * free}D + 4 * {x}.n * {lam!r}D)"
        if unlike is not None:
            z = f"({z} - ({x}.unlike - ({x}.n - 1) * {unlike!r}D) / sqrt(({x}.n - 1) * {unlike * (1 - unlike)!r}D)) / {math.sqrt(2)!r}D"
        cases.append(f"WHEN '{k}' THEN {z}")
    return f"CASE WHEN {x}.ok THEN CASE {x}.enc {' '.join(cases)} END END"


def lower_tail(z: Column) -> Column:
    """Normal distribution function for z < 0 by a continued fraction; 1/2 or more counts as 1."""
    x = -z
    return F.when(z >= 0, F.lit(1.0)).otherwise(
        F.exp(-x * x / 2) / math.sqrt(2 * math.pi) / (x + 1 / (x + 2 / (x + 3 / (x + 4 / (x + 0.65)))))
    )


def thresholds(scanned: DataFrame, kinds: dict[str, tuple[float, float | None]], q: float = FALSE_DISCOVERIES) -> dict[str, float]:
    """Per encoding, the largest z that Benjamini-Hochberg accepts at q over all tested tokens of the table, to the width of a bin."""
    hist = (
        scanned.select(F.explode("tokens").alias("t")).filter("t.ok IS NOT NULL").select("t.enc", F.expr(f"floor({_z('t', kinds)} / {BIN}D)").alias("bin"))
        .groupBy("enc", "bin").agg(F.count("*").alias("n"))
    )
    w = Window.partitionBy("enc")
    return {
        r.enc: r.z
        for r in hist.withColumn("m", F.sum("n").over(w)).filter("bin IS NOT NULL")
        .withColumn("r", F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("z", (F.col("bin") + 1) * BIN)
        .filter(lower_tail(F.col("z")) <= q * F.col("r") / F.col("m"))
        .groupBy("enc").agg(F.max("z").alias("z")).collect()
    }


def _every(scanned: DataFrame) -> Column:
    """All spans of a scanned table: the base ones and the tokens that its own tests find random."""
    kinds = ordinary(scanned)
    limits = thresholds(scanned, kinds)
    test = " OR ".join(f"(x.enc = '{k}' AND {_z('x', kinds)} < {v!r}D)" for k, v in sorted(limits.items())) or "false"
    return F.expr(f"array_sort(concat(base, transform(filter(tokens, x -> {test}), x -> struct(x.start, 3 AS kind, x.end))))")


def _named(spans: str) -> Column:
    names = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS))
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', CASE x.kind {names} END, x.start, x.end)), ',')")


def found(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for each row of docs.

    Null texts count as empty and have no spans. Positions are code points, ends exclusive. Private-use characters of the
    text are like any other. Repeated rows are scanned each; an empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = cut(scan(own).select(F.col("row.doc_id").alias("doc_id"), "base", "tokens"))
    count = lambda i: F.expr(f"cast(size(filter(base, x -> x.kind = {i})) AS long)")
    return scanned.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_named("base"), 256).alias("base_sha256"), _every(scanned).alias("every"),
    ).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", _named("every").alias("spans"))


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """docs with every span of its text replaced by mark, and n_chars set to the new length where such a column is there.

    Spans that overlap are replaced as one. Texts without spans, null among them, stay as they are.
    """
    scanned = cut(scan(docs))
    fold = f"""aggregate(every, named_struct('at', 0, 'out', ''),
        (a, x) -> named_struct('at', greatest(a.at, x.end), 'out', CASE WHEN x.start < a.at THEN a.out
          ELSE concat(a.out, substring(row.text, a.at + 1, x.start - a.at), {_lit(mark)}) END),
        a -> concat(a.out, substring(row.text, a.at + 1)))"""
    new = scanned.withColumn("every", _every(scanned)).withColumn("new", F.expr(f"CASE WHEN size(every) = 0 THEN row.text ELSE {fold} END"))
    out = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.col("new")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.expr("CASE WHEN size(every) = 0 THEN row.n_chars ELSE cast(length(new) AS long) END")
    return new.select(*(v.alias(k) for k, v in out.items()))
