"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Patterns find candidate spans in every whole text. Each candidate value is
hashed and the hashes are counted over the corpus by distinct repositories and
distinct owners. A value that many owners or very many repositories hold is a
copied example; one of few owners and not very many repositories that is not a
plain filler is a live-looking credential.

Spans count code points, the end is exclusive. Kinds:

- `assign`: a keyword, a separator and a value of 8 or more characters;
- `access`: an access key id of 16 or more characters;
- `hex`: 32 or more lower-case hex digits;
- `opaque`: 24 or more key characters with upper case, lower case and digits,
  outside the spans above. The frequency decides here: only live-looking ones
  are reported.

Defined cases: a null text is empty and has no spans; a null id, repository or
owner is a value of its own; every input row, also a repeated one, gives one
row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keptvisit.session import write_out

KEYWORDS = ["password", "passwd", "secret", "token", "api_?key"]
KINDS = ["assign", "access", "hex", "opaque"]
COPIED_OWNERS, COPIED_REPOSITORIES, LEAST_SYMBOLS = 3, 25, 6


def either_case(word: str) -> str:
    """A pattern for `word` in upper or lower ASCII case, alike in every regex engine."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = ("(" + "|".join(map(either_case, KEYWORDS))
          + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
PATTERNS = {
    "assign": ASSIGN,
    # Runs are greedy and maximal, so a minimum length in the pattern drops the same matches.
    "access": "AKIA[A-Z0-9]{12,}",
    "hex": "[0-9a-f]{32,}",
    "opaque": "[A-Za-z0-9+/_-]{24,}",
}
SPAN = "array<struct<start:int,rank:int,stop:int,kind:string,value:string>>"


def _ends(gaps: Column, found: Column) -> Column:
    """Where each match ends: the pieces between the matches and the matches, added up."""
    steps = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.length(g) + F.length(m))
    return F.aggregate(
        steps, F.array().cast("array<int>"),
        lambda ends, step: F.concat(
            ends, F.array(F.coalesce(F.get(ends, F.size(ends) - 1), F.lit(0)) + step)),
    )


def _value(kind: str, match: Column) -> Column:
    return F.regexp_extract(match, f"^{ASSIGN}$", 2) if kind == "assign" else match


def _passes(kind: str, span: Column) -> Column:
    if kind == "assign":
        return F.length(span["value"]) >= 8
    if kind == "opaque":
        return (span["value"].rlike("[A-Z]") & span["value"].rlike("[a-z]")
                & span["value"].rlike("[0-9]"))
    return F.lit(True)


def candidates(docs: DataFrame, *, id: str, text: str, repository: str, owner: str) -> DataFrame:
    """One row per input row: id, repository, owner, text_key and the candidate spans."""
    names = list(PATTERNS)
    rows = docs.select(
        F.col(id).alias("id"), F.col(repository).alias("repository"), F.col(owner).alias("owner"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("text_key", F.xxhash64("text"))
    rows = rows.withColumns({
        f"m_{k}": F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0)) for k in names})
    # Texts without a match, nearly all of them, are not split.
    rows = rows.withColumns({
        f"e_{k}": F.when(
            F.size(f"m_{k}") > 0,
            _ends(F.split("text", PATTERNS[k], -1), F.col(f"m_{k}")),
        ).otherwise(F.array().cast("array<int>")) for k in names})

    def spans(k: str) -> Column:
        whole = F.zip_with(
            f"e_{k}", f"m_{k}",
            lambda e, m: F.struct(
                (e - F.length(m)).alias("start"), F.lit(KINDS.index(k)).alias("rank"),
                e.alias("stop"), F.lit(k).alias("kind"), _value(k, m).alias("value")))
        return F.filter(whole, lambda s: _passes(k, s))

    rows = rows.select(
        "id", "repository", "owner", "text_key",
        F.array_sort(F.concat(*[spans(k) for k in names[:3]])).cast(SPAN).alias("base"),
        spans("opaque").cast(SPAN).alias("opaque"),
    )
    return rows.withColumn("opaque", F.filter("opaque", lambda o: ~F.exists(
        "base", lambda b: (b["start"] < o["stop"]) & (o["start"] < b["stop"]))))


def ownership(values: DataFrame) -> DataFrame:
    """Distinct repositories and owners per value hash; pairs are combined before each shuffle."""
    repositories = values.select("hash", "repository").distinct().groupBy("hash").agg(
        F.count(F.lit(1)).alias("n_repositories"))
    owners = values.select("hash", "owner").distinct().groupBy("hash").agg(
        F.count(F.lit(1)).alias("n_owners"))
    return repositories.join(owners, "hash")


def scan(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", repository: str = "doc_id",
    owner: str = "source", copied_owners: int = COPIED_OWNERS,
    copied_repositories: int = COPIED_REPOSITORIES, least_symbols: int = LEAST_SYMBOLS,
) -> DataFrame:
    """One row per input row with its secrets.

    Columns: id, text_key (a hash of the text), `spans`, an array ordered by
    start and kind of (start, rank, stop, kind, value, n_repositories, n_owners,
    live). A value is live when fewer than `copied_owners` owners and fewer than
    `copied_repositories` repositories hold it and it has at least `least_symbols`
    different characters.
    """
    rows = write_out(
        candidates(docs, id=id, text=text, repository=repository, owner=owner)
        .withColumn("row", F.monotonically_increasing_id()), "secrets")
    spans = rows.select(
        "row", "repository", "owner", F.explode(F.concat("base", "opaque")).alias("span")
    ).withColumn("hash", F.md5("span.value"))
    judged = (
        spans.select("row", "hash", "span")
        .join(ownership(spans), "hash")
        .select(
            "row",
            F.struct(
                "span.start", "span.rank", "span.stop", "span.kind", "span.value",
                "n_repositories", "n_owners",
                ((F.col("n_owners") < copied_owners) & (F.col("n_repositories") < copied_repositories)
                 & (F.size(F.array_distinct(F.split("span.value", ""))) >= least_symbols)
                 ).alias("live"),
            ).alias("span"))
        .filter("span.kind != 'opaque' or span.live")
        .groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("spans"))
    )
    kind = judged.schema["spans"].dataType
    return rows.select("row", "id", "text_key").join(judged, "row", "left").select(
        "id", "text_key", F.coalesce("spans", F.array().cast(kind)).alias("spans"))


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])))


def report(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts, digests and the verdicts per row of `scan`."""
    base = F.filter("spans", lambda s: s["rank"] < 3)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("id").alias(id),
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_copied"),
        *[F.coalesce(F.array_max(F.transform("spans", lambda s: s[f"n_{held}"])), F.lit(0)).cast("long").alias(f"most_{held}")
          for held in ("repositories", "owners")],
    )


def redact(
    docs: DataFrame, found: DataFrame, *, id: str = "doc_id", text: str = "text",
    chars: str | None = None, mark: str = "[SECRET]", few: int = 100_000,
) -> DataFrame:
    """`docs` with every live span of `found` replaced by `mark`; other rows are unchanged.

    `chars` names a column with the text's code points, which follows the text.
    Rows are matched by id and text. The matched side is broadcast while it
    holds at most `few` spans, and joined by a shuffle beyond that.
    """
    live = found.select(
        "id", "text_key", F.filter("spans", lambda s: s["live"]).alias("spans"),
    ).filter(F.size("spans") > 0).dropDuplicates(["id", "text_key"])
    live = write_out(live, "live-secrets")
    total = live.agg(F.sum(F.size("spans"))).first()[0] or 0
    if total <= few:
        live = F.broadcast(live)
    columns = docs.columns
    # In one struct, no column of docs can clash with the others.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"))
    body = F.coalesce(F.col(f"doc.`{text}`"), F.lit(""))

    def put(done: Column, s: Column) -> Column:
        return F.when(s["start"] < done["at"], F.struct(
            F.greatest(done["at"], s["stop"]).alias("at"), done["out"].alias("out"),
        )).otherwise(F.struct(
            s["stop"].alias("at"),
            F.concat(done["out"], F.substring(body, done["at"] + 1, s["start"] - done["at"]),
                     F.lit(mark)).alias("out")))

    clean = F.aggregate(
        "spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), put,
        lambda done: F.concat(done["out"], F.substring(body, done["at"] + 1, F.length(body))))
    rows = rows.withColumn("key", F.xxhash64(body)).join(
        live, F.col(f"doc.`{id}`").eqNullSafe(F.col("id")) & (F.col("key") == F.col("text_key")), "left",
    ).withColumn("clean", F.when(F.col("spans").isNotNull(), clean))
    return rows.select(*[_changed(c, text, chars, F.col("clean"), docs) for c in columns])


def _changed(column: str, text: str, chars: str | None, new: Column, docs: DataFrame) -> Column:
    """A column of the struct `doc`, with a new text where there is one."""
    old = F.col(f"doc.`{column}`")
    if column == text:
        old = F.coalesce(new, old)
    elif column == chars:
        old = F.coalesce(F.length(new).cast(docs.schema[column].dataType), old)
    return old.alias(column)


def _sql_spans(kind: str) -> str:
    """DuckDB: the passing matches of a kind as structs, for the text column t."""
    ends = (f"list_sum(list_transform(p_{kind}[1:i], lambda x: length(x)))"
            f" + list_sum(list_transform(m_{kind}[1:i], lambda x: length(x)))")
    value = f"regexp_extract(m_{kind}[i], {_quoted(ASSIGN)}, 2)" if kind == "assign" else f"m_{kind}[i]"
    keep = {
        "assign": "length(s.value) >= 8",
        "opaque": "regexp_matches(s.value, '[A-Z]') and regexp_matches(s.value, '[a-z]')"
                  " and regexp_matches(s.value, '[0-9]')",
    }.get(kind, "true")
    return (f"list_filter(list_transform(range(1, len(m_{kind}) + 1), lambda i: "
            f"{{'start': cast({ends} - length(m_{kind}[i]) as int), 'rank': {KINDS.index(kind)}, "
            f"'stop': cast({ends} as int), 'kind': '{kind}', 'value': {value}}}), "
            f"lambda s: {keep})")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def oracle(
    table: str = "documents", copied_owners: int = COPIED_OWNERS,
    copied_repositories: int = COPIED_REPOSITORIES, least_symbols: int = LEAST_SYMBOLS,
) -> str:
    """DuckDB SQL for `report(scan(...))` with the default columns."""
    finds = ", ".join(
        f"regexp_extract_all(t, {_quoted(p)}) as m_{k}, regexp_split_to_array(t, {_quoted(p)}) as p_{k}"
        for k, p in PATTERNS.items())
    join = "array_to_string(list_transform({0}, lambda s: s.kind || ':' || s.start || ':' || s.stop), ',')"
    return f"""
with texts as (
  select row_number() over () as row, doc_id, source, coalesce(text, '') as t from {table}),
matches as (select row, doc_id, source, {finds} from texts),
found as (
  select row, doc_id, source,
    list_concat(list_concat({_sql_spans('assign')}, {_sql_spans('access')}), {_sql_spans('hex')}) as base,
    {_sql_spans('opaque')} as opaque
  from matches),
spans as (
  select row, doc_id, source, unnest(list_concat(base, list_filter(opaque,
    lambda o: len(list_filter(base, lambda b: b.start < o.stop and o.start < b.stop)) = 0))) as span
  from found),
owners as (
  select span.value as value, count(distinct source) + max(cast(source is null as int)) as n,
    count(distinct doc_id) + max(cast(doc_id is null as int)) as r
  from spans group by 1),
judged as (
  select row, span, n, r, n < {copied_owners} and r < {copied_repositories}
    and len(list_distinct(string_split(span.value, ''))) >= {least_symbols} as live
  from spans join owners on span.value = value),
lists as (
  select row, list(span order by span.start, span.rank) as spans,
    list(span order by span.start, span.rank) filter (span.rank < 3) as base,
    count(*) filter (span.kind = 'assign') as n_assign,
    count(*) filter (span.kind = 'access') as n_access,
    count(*) filter (span.kind = 'hex') as n_hex,
    count(*) filter (span.kind = 'opaque') as n_opaque,
    count(*) filter (live) as n_live, count(*) filter (not live) as n_copied,
    max(r) as most_repositories, max(n) as most_owners
  from judged where span.kind != 'opaque' or live group by row)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
  coalesce(n_hex, 0) as n_hex, coalesce(n_opaque, 0) as n_opaque,
  sha256(coalesce({join.format('base')}, '')) as base_sha256,
  coalesce({join.format('spans')}, '') as spans,
  coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied,
  cast(coalesce(most_repositories, 0) as bigint) as most_repositories,
  cast(coalesce(most_owners, 0) as bigint) as most_owners
from texts left join lists using (row)"""
