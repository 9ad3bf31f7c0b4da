"""Secret scans with multipart credential linking (operator 4), in DataFrame operations only.

Patterns find parts in whole texts: strong secrets (assignments with a long value,
access key ids, long hex runs) are always reported. Weak candidates - short assigned
secrets, bare runs of 40 base64 characters, account names, and access keys that may be either -
and endpoints are parts too. A weak candidate is reported
only when a complementary part lies in the same scope (a block between blank lines or
runs of at least ``GAP`` blanks), however far apart: for a secret an account name, an access key (id) or an endpoint, for an
account name a secret or an access key, for an access key any of the three. The linking is evaluated as a window over the parts of a
scope, so no pairs are made and the work is linear in the parts.

Positions come from two built-in functions on the same pattern: the matches
(``regexp_extract_all``) and the pieces between them (``split``), whose lengths in code
points are summed along the text. The sums run over exploded rows, one per match, so a
text with very many matches costs no more than its matches. Only parts are shuffled,
never texts; a text with no match of a pattern is matched once against it.

Defined cases: null text is empty; rows that agree in id and text have the same spans;
null ids are ids of their own; an empty table gives an empty result; other columns are
not read. Spans are ``kind:start:end`` in code points, end exclusive, by start and then
kind as listed in ``KINDS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import table, text_or_empty

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16

# The linking patterns. A maximal run needs no second look, so its least length is in the pattern.
ACCESS_LONG = r"AKIA[A-Z0-9]{14,}"
HEX_LONG = r"[0-9a-f]{16,}"
_VALUE = r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@=!#%&*-]"""
# Names may have a prefix that ends in anything but a letter or a digit.
_START = "(?<![A-Za-z0-9])"
ACCOUNT = f"(?i:{_START}(?:user_?name|user_?id|user|login|client_?id|account_?id|access_?key_?id))" + _VALUE + "{2,}"
#: Names either half of a pair has: the id beside a secret key, or the secret beside an account name.
ACCESS_KEY = f"(?i:{_START}(?<!secret_?)access_?key)" + _VALUE + "{4,}"
SHORT_SECRET = (f"(?i:{_START}(?:password|passwd|passphrase|pass|pwd|secret|token|auth|api_?key|private_?key|client_?key|client_?secret|"
                "secret_?key|secret_?access_?key))" + _VALUE + "{4,}")
KEY_RUN = "(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{38}(?:[A-Za-z0-9+/]{2}|[A-Za-z0-9+/]=|==)(?![A-Za-z0-9+/=])"
ENDPOINT = r"(?i:\b(?:https?|ftp|sftp|ssh|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp))://[^\x20\x09-\x0D\"'<>]+"
GAP = 200  # blanks in a row that end a scope as a blank line does
BREAK = rf"\n[\x20\t\r]*\n|(?<![\x20\t])[\x20\t]{{{GAP},}}"

#: In the order in which kinds with the same start are listed.
KINDS = ("assign", "access", "hex", "account", "access_key", "short_secret", "key_run", "endpoint", "break")
BASE = KINDS[:3]
WEAK = ((ACCOUNT, "account"), (ACCESS_KEY, "access_key"), (SHORT_SECRET, "short_secret"), (KEY_RUN, "key_run"))
HIDDEN = "[SECRET]"


def _parts(text: Column, pattern: str, kind: str, keep, when: Column | None = None) -> Column:
    """array<struct(kind, i, gap, len, ok)>: the matches in order, with the code points before each."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if when is not None:
        found = F.when(when, found).otherwise(F.array().cast("array<string>"))
    rows = F.transform(
        F.arrays_zip(found.alias("m"), F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("g")),
        lambda x, i: F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"),
                              F.length(x["m"]).alias("len"), keep(x["m"]).alias("ok")))
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,len:int,ok:boolean>>")
    return F.when(F.size(found) > 0, rows).otherwise(none)


def _always(_: Column) -> Column:
    return F.lit(True)


def _with_parts(rows: DataFrame, when: Column | None = None) -> DataFrame:
    """``rows`` with ``_parts``, the matches of all patterns in ``_text`` before linking (null where ``when`` is false)."""
    weak = [_parts(F.col("_text"), p, k, _always) for p, k in WEAK]
    base = (_parts(F.col("_text"), ASSIGN, "assign", lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= MIN_ASSIGN),
            _parts(F.col("_text"), ACCESS_LONG, "access", _always), _parts(F.col("_text"), HEX_LONG, "hex", _always))
    only = lambda x: x if when is None else F.when(when, x)
    rows = rows.withColumns({"_base": only(F.concat(*base)), "_weak": only(F.concat(*weak))})
    some = F.size("_weak") > 0
    extra = F.concat(_parts(F.col("_text"), ENDPOINT, "endpoint", _always, some),
                     _parts(F.col("_text"), BREAK, "break", _always, some))
    return rows.withColumn("_parts", only(F.concat("_base", "_weak", extra))).drop("_base", "_weak")


def scan(docs: DataFrame) -> DataFrame:
    """Every row's (doc_id, _hash, _parts)."""
    rows = _with_parts(docs.select("doc_id", text_or_empty().alias("_text")))
    return rows.select("doc_id", F.xxhash64("_text").alias("_hash"), "_parts")


def spans(scanned: DataFrame) -> DataFrame:
    """(doc_id, _hash, kind, start, end) of every reported span of the distinct (doc_id, text)."""
    once = scanned.where(F.size("_parts") > 0).groupBy("doc_id", "_hash").agg(F.first("_parts").alias("_parts"))
    rows = once.select("doc_id", "_hash", F.inline("_parts"))
    along = Window.partitionBy("doc_id", "_hash", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("len")).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("len")).where("ok")
    kind = {k: F.col("kind") == i for i, k in enumerate(KINDS)}
    is_base = F.col("kind") < len(BASE)
    named = kind["account"] | kind["access_key"] | kind["short_secret"]
    # scope: breaks passed; a weak candidate inside a base span is that span, a key run inside a named part is that part
    text_order = Window.partitionBy("doc_id", "_hash").orderBy("start", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_scope", F.count_if(kind["break"]).over(text_order)).withColumn(
        "_covered", F.max(F.when(is_base, F.col("end"))).over(text_order)).withColumn(
        "_named", F.max(F.when(named, F.col("end"))).over(text_order)).withColumn(
        "_in_endpoint", F.coalesce(F.max(F.when(kind["endpoint"], F.col("end"))).over(text_order) > F.col("start"), F.lit(False)))
    weak = named | kind["key_run"]
    rows = rows.where(~kind["break"] & ~(weak & (F.coalesce(F.col("_covered"), F.lit(0)) > F.col("start"))) &
                      ~(kind["key_run"] & (F.coalesce(F.col("_named"), F.lit(0)) > F.col("start"))))
    scope = Window.partitionBy("doc_id", "_hash", "_scope")
    has_account = F.max(kind["account"] | kind["access"]).over(scope)
    has_endpoint = F.max(kind["endpoint"]).over(scope)
    has_secret = F.max(kind["short_secret"] | kind["key_run"] | kind["assign"] | kind["hex"]).over(scope)
    has_key = F.max(kind["access_key"]).over(scope)
    linked = (is_base | (kind["short_secret"] & (has_account | has_key | has_endpoint)) | (kind["account"] & (has_secret | has_key)) |
              (kind["key_run"] & (has_account | has_key | (has_endpoint & ~F.col("_in_endpoint")))) |
              (kind["access_key"] & (has_account | has_secret | has_endpoint)))
    return rows.withColumn("_linked", linked).where("_linked").select("doc_id", "_hash", "kind", "start", "end")


def _listed(rows: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(rows, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    scanned = cut_lineage(scan(docs))
    found = spans(scanned).groupBy("doc_id", "_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("_all"))
    left, right = scanned.select("doc_id", "_hash").alias("l"), found.alias("r")
    joined = left.join(right, F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l._hash") == F.col("r._hash")), "left")
    every = F.coalesce(F.col("_all"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    base = F.filter(every, lambda s: s["kind"] < len(BASE))
    counts = [F.size(F.filter(every, lambda s: s["kind"] == 0)).cast("bigint").alias("n_assign"),
              F.size(F.filter(every, lambda s: s["kind"] == 1)).cast("bigint").alias("n_access"),
              F.size(F.filter(every, lambda s: s["kind"] == 2)).cast("bigint").alias("n_hex")]
    return joined.select(F.col("l.doc_id").alias("doc_id"), *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
                         _listed(every).alias("spans"))


def hide_secrets(docs: DataFrame, hidden: str = HIDDEN) -> DataFrame:
    """``docs`` with every reported span replaced by ``hidden``; ``n_chars`` follows the text.

    Texts are searched once: the rows are checkpointed with the parts found in them. Only rows with parts meet the table of
    spans; all others pass as they are, so the join moves the few texts that may change.
    """
    row = docs.select(F.struct("*").alias("_row"), text_or_empty().alias("_text"))
    patterns = (ASSIGN, ACCESS_LONG, HEX_LONG, *(p for p, _ in WEAK))
    suspect = F.lit(False)
    for p in patterns:
        suspect = suspect | F.col("_text").rlike(p)
    held = cut_lineage(_with_parts(row.withColumn("_suspect", suspect), F.col("_suspect")).select("_row", "_suspect", "_parts"))
    marked = held.withColumn("_text", F.coalesce("_row.text", F.lit("")))
    found = spans(marked.where("_suspect").select("_row.doc_id", F.xxhash64("_text").alias("_hash"), "_parts"))
    # merge overlapping spans
    order = Window.partitionBy("doc_id", "_hash").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    merged = found.withColumn("_new", F.coalesce(F.col("start") >= before, F.lit(True)).cast("int")).withColumn(
        "_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = merged.groupBy("doc_id", "_hash", "_run").agg(F.min("start").alias("s"), F.max("end").alias("e"))
    merged = merged.groupBy("doc_id", "_hash").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("_cuts"))
    left = marked.where("_suspect").withColumn("_hash", F.xxhash64("_text")).alias("l")
    joined = left.join(merged.alias("r"), F.col("l._row.doc_id").eqNullSafe(F.col("r.doc_id")) &
                       (F.col("l._hash") == F.col("r._hash")), "left")
    cuts = F.col("_cuts")
    kept = F.transform(cuts, lambda c, i: F.concat(_between(F.col("_text"), F.coalesce(F.get(cuts, i - 1)["e"], F.lit(0)), c["s"]),
                                                   F.lit(hidden)))
    tail = _between(F.col("_text"), F.element_at(cuts, -1)["e"], F.length("_text"))
    text = F.when(cuts.isNull(), F.col("_row.text")).otherwise(F.concat(F.array_join(kept, ""), tail))
    changed = joined.select(F.col("_row").withField("text", text).alias("_row"), cuts.isNotNull().alias("_hit"))
    if "n_chars" in docs.columns:
        n = F.when(F.col("_hit"), F.length("_row.text")).otherwise(F.col("_row.n_chars"))
        changed = changed.select(F.col("_row").withField("n_chars", n.cast(docs.schema["n_chars"].dataType)).alias("_row"))
    return marked.where(~F.col("_suspect")).select("_row.*").unionByName(changed.select("_row.*"))


def _between(text: Column, start: Column, end: Column) -> Column:
    return text.substr((start + 1).cast("int"), (end - start).cast("int"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
