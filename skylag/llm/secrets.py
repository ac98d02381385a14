"""Secret scan with linking of multipart credentials.

Strong patterns (assign, access, hex) are reported as they are. Weak ones mean
little alone: an identifier beside a key word, a long mixed token, an address.
They are reported only where the parts that complete a credential lie within
``SCOPE`` code points: a token needs an identifier, an identifier a secret, an
address both. Strong spans count as parts too.

Only expressions and joins are used. One pass cuts each text by its patterns and
turns the pieces' lengths into spans; the spans are written with a row number.
Linking is an interval join of weak spans with the parts around them, by row, role
and tiles of the text that both lie in; the distance is the gap between the spans. It
is a semi-join, so no pairs are made, and tiles split a long text of many spans.

Defined cases: a null text is an empty one and has no span; repeated rows are
scanned one by one; a weak span that touches a strong one is left out; an empty
table gives an empty one. Extra columns are kept; those named like the columns
added are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.llm.common import aside, content_key, materialise, table, unused

SCOPE = 200
TILE = 512
RUN = 128
REDACTED = "[redacted]"

_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
# Kinds in the order of the report, with pattern, the group that must
# have so many characters, and that number.
STRONG = (
    ("assign", rf"(?i:(password|passwd|secret|token|api_?key)){_VALUE}([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
WEAK = (
    ("id", rf"(?i:access_?key_?id|client_?id|account_?id|user_?name|login|user){_VALUE}([A-Za-z0-9@._-]+)", 1, 3),
    ("value", r"[A-Za-z0-9+/_-]{20,}={0,2}", 0, 20),
    ("endpoint", r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?[A-Za-z0-9/_.~-]*", 0, 10),
)
KINDS = [kind for kind, *_ in STRONG + WEAK]
# The part of a credential that a kind is, and those a weak kind needs around it.
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "id": "identifier", "value": "secret", "endpoint": "endpoint"}
NEEDS = {"id": ["secret"], "value": ["identifier"], "endpoint": ["identifier", "secret"]}

_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, number: int, pattern: str, group: int, least: int) -> Column:
    """Spans of the leftmost matches of a pattern whose group is long enough.

    Matches and what lies between them alternate, so their lengths add up to the
    places of the matches.
    """
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    whole = F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), lambda x: F.length(x))
    inner = F.regexp_extract_all(text, F.lit(pattern), group)
    long_enough = F.transform(inner, lambda x: F.length(x) >= least)
    if number == KINDS.index("value"):  # a mixed token, not a long word
        long_enough = F.transform(inner, lambda x: x.rlike("[0-9]") & x.rlike("[A-Z]") & x.rlike("[a-z]"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found"))

    def add(done: Column, piece: Column) -> Column:
        start = done["at"] + piece["between"]
        end = start + F.coalesce(piece["whole"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        found = F.when(piece["keep"], F.concat(done["found"], F.array(span))).otherwise(done["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("found"))

    def join(done: Column, run: Column) -> Column:
        moved = F.transform(run["found"], lambda s: F.struct((s["start"] + done["at"]).alias("start"), s["kind"], (s["end"] + done["at"]).alias("end")))
        return F.struct((done["at"] + run["at"]).alias("at"), F.concat(done["found"], F.array(moved)).alias("found"))

    def summed(pieces: Column) -> Column:
        """A list grows by copying, so pieces are added up in runs and then the runs."""
        numbers = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / RUN).cast("int"))
        runs = F.transform(numbers, lambda k: F.aggregate(F.slice(pieces, k * RUN + 1, RUN), zero, add))
        return F.aggregate(runs, none, join, lambda done: F.flatten(done["found"]))

    # In a list of one, so that the pieces are a variable and are found once.
    pieces = F.arrays_zip(between.alias("between"), whole.alias("whole"), long_enough.alias("keep"))
    spans = F.get(F.transform(F.array(pieces), summed), F.lit(0))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPANS))


def scanned(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` (strong spans in order) and ``weak`` (spans to be linked)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    strong = [_spans(text, i, *rest) for i, (_, *rest) in enumerate(STRONG)]
    weak = [_spans(text, i, *rest) for i, (_, *rest) in enumerate(WEAK, len(STRONG))]
    found = docs.withColumns({"base": F.array_sort(F.concat(*strong)), "weak": F.concat(*weak)})
    clear = F.filter("weak", lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    return found.withColumn("weak", clear)


def _by_kind(values: dict[str, str | list[str]], number: Column) -> Column:
    texts = F.array(*[F.array(*map(F.lit, v)) if isinstance(v := values.get(k, []), list) and v else F.lit(v) if isinstance(v, str) else F.array().cast("array<string>") for k in KINDS])
    return F.get(texts, number)


def linked(rows: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(_row, more): of ``rows`` (_row, base, weak), the weak spans whose complements
    lie in scope."""
    open_rows = rows.where(F.size("weak") > 0)
    parts = open_rows.select("_row", F.explode(F.concat("base", "weak")).alias("p"))
    tiles = F.sequence(F.floor((F.col("p.start") - scope) / TILE), F.floor((F.col("p.end") + scope) / TILE))
    parts = parts.select("_row", _by_kind(ROLE, F.col("p.kind")).alias("role"), F.explode(tiles).alias("tile"), "p")
    weak = open_rows.select("_row", F.explode("weak").alias("w"))
    weak = weak.withColumn("needs", _by_kind(NEEDS, F.col("w.kind")))
    weak = weak.select("_row", "w", F.size("needs").alias("n"), F.explode("needs").alias("role"))
    # Every tile the span lies in: a part is near its start or its end.
    weak = weak.withColumn("tile", F.explode(F.sequence(F.floor(F.col("w.start") / TILE), F.floor(F.col("w.end") / TILE))))
    w, p = weak.alias("l"), parts.alias("r")
    near = (F.col("w.start") <= F.col("p.end") + scope) & (F.col("w.end") >= F.col("p.start") - scope)
    on = (F.col("l._row") == F.col("r._row")) & (F.col("l.role") == F.col("r.role")) & (F.col("l.tile") == F.col("r.tile")) & near
    met = w.join(p, on, "left_semi").groupBy("_row", "w", "n").agg(F.count_distinct("role").alias("met"))
    return met.where("met = n").groupBy("_row").agg(F.collect_list("w").alias("more"))


def scan(docs: DataFrame, scope: int = SCOPE, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with base and spans: arrays of (start, kind, end), the kind a number in
    ``KINDS``; spans holds the linked ones too. Columns in ``drop`` are not carried on."""
    docs, back = aside(docs.select(*[c for c in docs.columns if c not in ("base", "spans")]), "weak", "more", "_row")
    rows = materialise(scanned(docs).drop(*drop).withColumn("_row", F.monotonically_increasing_id()), "spans")
    more = linked(rows.select("_row", "base", "weak"), scope)
    found = rows.drop("weak").join(more, "_row", "left").drop("_row")
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(_SPANS))))
    return back(found.withColumn("spans", spans).drop("more"))


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    texts = F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def redacted(text: Column, spans: Column, mark: str = REDACTED) -> Column:
    """``text`` with each run of spans replaced by ``mark``."""
    part = "array<struct<start:int,end:int>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(part).alias("kept"))

    def add(done: Column, span: Column) -> Column:
        between = F.struct(done["at"].alias("start"), span["start"].alias("end"))
        new = (span["start"] >= done["at"]) & (span["end"] > done["at"])
        kept = F.when(new, F.concat(done["kept"], F.array(between))).otherwise(done["kept"])
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), kept.alias("kept"))

    # What stays is cut out of the list of characters, for a text would be read from its
    # start for every piece, and joined once.
    whole = F.array(F.struct(F.lit(0).alias("start"), F.length(text).alias("end")))
    kept = F.aggregate(spans, zero, add, lambda done: F.concat(done["kept"], F.transform(whole, lambda w: F.struct(done["at"].alias("start"), w["end"]))))

    def cut(letters: Column) -> Column:
        pieces = F.transform(kept, lambda k: F.array_join(F.slice(letters, k["start"] + 1, k["end"] - k["start"]), ""))
        return F.array_join(pieces, mark)

    rest = F.get(F.transform(F.array(F.split(text, "")), cut), F.lit(0))
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets of every text replaced and n_chars, if there, counted anew.

    What is stored are keys of texts with secrets and their spans.
    """
    key, at, spans = content_key("text"), unused("key"), unused("spans")
    found = scan(docs.select(key.alias("key"), "text"), drop=("text",)).where(F.size("spans") > 0)
    found = materialise(found.select(F.col("key").alias(at), F.col("spans").alias(spans)).dropDuplicates([at]), "secrets")
    rows = docs.withColumn(at, key).join(found, at, "left")
    rows = rows.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(redacted(F.col("text"), F.col(spans))))
    if "n_chars" in docs.columns:
        changed = F.when(F.col(spans).isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
        rows = rows.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, drop=("text",))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind, *_ in STRONG],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
