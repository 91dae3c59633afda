"""The library's own queries over the driver tables, and their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import elements, layout, lines, markup, publish, relations, renames, rules
from .plans import reports
from .sources import corpus, ordered

_QUERIES: dict = {}
_SQL: dict[str, str] = {}

#: Text that is added to documents by turns, so that rules for markup find something.
SNIPPETS = [
    "plain end",
    r"$a$ \left( x \right) and \left[ y",
    "<math>a</math> <center> </center>",
    r"$$ {a \{ b $$ and $$ {c} $$",
    r"\begin{array} x \end{array} \begin{cases}",
    "rule of the shorter term",
    "# One\n### Three\ntext",
    "## See also\nrule of the shorter term\n## Next",
    "{{note text}} � ",
    "```\n  | a |\n```\n| a |\n| b |\n  | c |",
    "```\nopen fence",
    "<p>old</p> <iaci> <Div class='x'> <see 3, x> </Mb >",
    r"\left( no formula \begin{array}",
    "$$ x $$ .\n$$ y $$ tail\n$$ z $$\n" + r"$a \right\\left. b$ \right\\left\{",
    "<math\nx='1'>a <center\nclass='c'>\n</center> $$ {{a}} $$ $$ {a\\\\{ b} $$ $$$$",
    "## References\n\nThis work was published before January 1\nlonger tail",
]


def query(sql: str | None = None):
    def register(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(items) -> str:
    return "[" + ", ".join(_q(s) for s in items) + "]"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _injected(spark, sf_dir) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    extra = F.element_at(F.array(*[F.lit(s) for s in SNIPPETS]), (F.col("doc_id") % len(SNIPPETS) + 1).cast("int"))
    return docs.select("doc_id", "lang", F.concat("text", F.lit("\n"), extra).alias("text"))


INJECTED = f"(select doc_id, lang, text || chr(10) || {_list(SNIPPETS)}[doc_id % {len(SNIPPETS)} + 1] as text from documents)"


def _lines_sql(t: str) -> str:
    return (
        "(select doc_id, unnest(range(1, len(ls) + 1)) as line_no, unnest(ls) as line "
        f"from (select doc_id, string_split(text, chr(10)) as ls from {t}))"
    )


def _count(pattern: str) -> str:
    return f"len(regexp_extract_all(text, {_q(pattern)}))"


def _lines_where(condition: str) -> str:
    return f"len([x for x in string_split(text, chr(10)) if {condition}])"


_TRAILER = f"regexp_matches(x, {_q('(?s)' + rules.TRAILER)}) and not contains(regexp_extract(x, {_q('(?s)' + rules.TRAILER)}, 1), '$$')"
_UNBALANCED = "length(replace(s, '{', '')) <> length(replace(s, '}', ''))"


def _rules_sql(t: str) -> str:
    """``doc_id, code, severity, n``: hits of the rules on the texts of ``t``, which have no headers."""
    def row(code, severity, n, math=False):
        return f"select doc_id, '{code}' as code, '{severity}' as severity, cast({n} as bigint) as n from {t}" + " where contains(text, '$')" * math

    near_math = _count(r"(?s)\$\$.{0,8}" + rules.TEMPLATE)
    stripped = "[regexp_replace(s, '\\\\[\\\\{}]', '', 'g') for s in " + f"regexp_extract_all(text, {_q(rules.FORMULA)}, 1)]"
    begins, ends = (f"regexp_extract_all(text, {_q(chr(92) * 2 + w + rules.ENVIRONMENT)}, 1)" for w in ("begin", "end"))
    envs = f"list_distinct(list_concat({begins}, {ends}))"
    off = f"abs(len([y for y in {begins} if y = x]) - len([y for y in {ends} if y = x]))"
    levels = "[length(h) for h in " + f"regexp_extract_all(text, {_q(rules.HEADING)}, 1)]"
    footer = f"regexp_matches(s, '^##\\s+(?:{rules.FOOTERS})[ \\t]*(?:\\n|$)')"
    debris = " or ".join(f"contains(s, {_q(d)})" for d in rules.DEBRIS)
    sections = "string_split(replace(text, chr(10) || '## ', chr(10) || chr(1) || '## '), chr(10) || chr(1))"
    parts = [
        row("M001", "error", f"abs({_count(rules.LEFT)} - {_count(rules.RIGHT)})", True),
        row("M002", "error", _count(rules.BROKEN), True),
        row("M003", "warn", _lines_where(_TRAILER), True),
        row("M004", "error", _count(rules.MATH_TAG)),
        row("M005", "error", f"len([s for s in {stripped} if {_UNBALANCED}])", True),
        row("M006", "error", f"abs(len({begins}) - len({ends}))", True),
        row("M007", "error", f"coalesce(list_sum([{off} for x in {envs}]), 0)", True),
        row("W001", "error", " + ".join(f"contains(text, {_q(d)})::int" for d in rules.DEBRIS)),
        row("W002", "error", f"len([s for s in {sections} if {footer} and ({debris})])"),
        row("W003", "warn", f"{_count(rules.TEMPLATE)} - {near_math}"),
        row("H001", "warn", _count(rules.EMPTY_CENTER)),
        row("H002", "warn", f"(len([i for i in range(2, len({levels}) + 1) if {levels}[i] > {levels}[i - 1] + 1]) > 0)::int"),
        row("B001", "error", "(length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) < 100)::int"),
        row("U001", "error", _count(r"\x{FFFD}")),
        row("U002", "warn", _count(r"[\x{E000}-\x{F8FF}]")),
        row("C001", "error", _lines_where("starts_with(x, '```')") + " % 2"),
        row("X001", "warn", _count(rules.KNOWN_TAG)),
        row("X002", "error", f"len([x for x in regexp_extract_all(text, {_q(rules.TAG)}, 1) if not list_contains({_list(rules.ELEMENTS)}, lower(x))])"),
        row("L001", "warn", f"({_lines_where('length(x) > 20000')} > 0)::int"),
    ]
    return "(select * from (" + " union all ".join(parts) + ") where n > 0)"


@query(
    f"select lang, code, severity, count(*) as n_docs, sum(n)::bigint as n_hits from {_rules_sql(INJECTED)} join documents using (doc_id) group by all"
)
def lint_summary_by_lang(spark, sf_dir):
    return reports.summary_by_lang(_injected(spark, sf_dir))


@query(
    f"select doc_id, case when bool_or(severity = 'error') then 'blocked' else 'advisory' end as status from {_rules_sql(INJECTED)} group by doc_id"
)
def quality_gate(spark, sf_dir):
    return reports.gate(_injected(spark, sf_dir))


@query(
    f"""select count(distinct doc_id) as n_docs, sum(n)::bigint as n_issues, sum(n) filter (severity = 'error')::bigint as n_errors, sum(n) filter (severity = 'warn')::bigint as n_warnings,
    sum(n) filter (code in ('M002', 'M003', 'W001', 'W002', 'H001'))::bigint as n_fixable, 'failed' as status from {_rules_sql(INJECTED)}"""
)
def lint_totals(spark, sf_dir):
    return reports.totals(_injected(spark, sf_dir))


def _marked_sql(code: str, pattern: str, condition: str = "true") -> str:
    marked = f"string_split(regexp_replace(text, {_q(pattern)}, chr(1) || chr(92) || '0', 'g'), chr(10))"
    return f"""select doc_id, '{code}' as code, line::int as line, (length(x) - length(replace(x, chr(1), '')))::bigint as n
    from (select doc_id, unnest(range(1, len(ls) + 1)) as line, unnest(ls) as x from (select doc_id, {marked} as ls from {INJECTED} where {condition})) where contains(x, chr(1))"""


@query(
    "select * from (" + " union all ".join([
        _marked_sql("M002", rules.BROKEN, "contains(text, '$')"), _marked_sql("M004", rules.MATH_TAG), _marked_sql("H001", rules.EMPTY_CENTER),
        f"select doc_id, 'M003' as code, line_no::int as line, 1::bigint as n from (select doc_id, line_no, line as x from {_lines_sql(INJECTED)}) where {_TRAILER}",
        f"""select doc_id, 'W001' as code, (length(p) - length(replace(p, chr(10), '')) + 1)::int as line, 1::bigint as n
        from (select doc_id, substr(text, 1, strpos(text, d) - 1) as p from (select *, unnest({_list(rules.DEBRIS)}) as d from {INJECTED}) where contains(text, d))""",
    ]) + ")"
)
def issue_lines(spark, sf_dir):
    found = rules.issues(_injected(spark, sf_dir), "doc_id", codes=("M002", "M003", "M004", "H001", "W001"))
    return found.select("doc_id", "code", "line", "n")


@query(
    f"""select doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?s)\\s+## See also\\nrule of the shorter term\\n## Next$', chr(10)),
    '(?s)\\s+## References\\n\\nThis work was published.*$', chr(10)), '\\\\right\\\\\\\\left([\\\\.])', '\\\\right\\\\}}\\\\left\\1', 'g'), '(?m)^(\\$\\$ .* \\$\\$)[.,;:!?]+\\s*$', '\\1', 'g'),
    '<center[^>]*>\\s*</center>', '', 'g')) as digest from {INJECTED}"""
)
def fixed_texts(spark, sf_dir):
    return _injected(spark, sf_dir).select("doc_id", F.md5(rules.fix_text("text").cast("binary")).alias("digest"))


@query("select doc_id, 'E001' as code, 'error' as severity, 0 as line from documents where doc_id % 9 = 0")
def encoding_errors(spark, sf_dir):
    tail = F.when(F.col("doc_id") % 9 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    return rules.encoding_rule(_t(spark, sf_dir, "documents").select("doc_id", F.concat(F.col("text").cast("binary"), tail).alias("content")))


@query(
    f"""with m as (select doc_id, unnest(regexp_extract_all(text, '\\\\(?:begin|end)\\{{[a-z*]+\\}}')) as m from {INJECTED})
    select * from (select doc_id, regexp_extract(m, '\\{{([^}}]*)\\}}', 1) as env, sum(starts_with(m, '\\begin')::int)::bigint as n_begin,
    sum(1 - starts_with(m, '\\begin')::int)::bigint as n_end from m group by all) where n_begin <> n_end"""
)
def math_environments(spark, sf_dir):
    return rules.environment_rule(_injected(spark, sf_dir))


@query(
    f"""with h as (select doc_id, line_no, length(regexp_extract(line, '^(#{{1,6}})[ \\t]+[^ \\t]', 1)) as level from {_lines_sql(INJECTED)}),
    j as (select *, lag(level) over (partition by doc_id order by line_no) as b from h where level > 0)
    select doc_id, min(line_no)::int as line_no from j where level > b + 1 group by doc_id"""
)
def heading_jump(spark, sf_dir):
    return lines.heading_jumps(_injected(spark, sf_dir))


@query(
    f"""with l as (select *, sum(starts_with(ltrim(line, ' '), '```')::int) over (partition by doc_id order by line_no) as f,
    starts_with(ltrim(line, ' '), '```') as fence from {_lines_sql(INJECTED)}),
    i as (select doc_id, line_no, case when starts_with(ltrim(line, ' '), '|') and f % 2 = 0 and not fence then length(line) - length(ltrim(line, ' ')) end as ind from l),
    b as (select *, lag(ind) over (partition by doc_id order by line_no) as before from i)
    select doc_id, line_no::int as line_no from b where before is not null and ind <> before"""
)
def table_indent(spark, sf_dir):
    return lines.split_table_rows(_injected(spark, sf_dir))


_SUSPECT = "(trim(line) <> '' and not starts_with(line, '#') and length(trim(line)) < 65 and not ends_with(line, '  ') and not ends_with(line, chr(92)))"


@query(
    f"""with l as (select *, {_SUSPECT} as f from {_lines_sql('documents')}),
    g as (select *, sum((not f)::int) over (partition by doc_id order by line_no) as g from l),
    r as (select doc_id, g, count(*) as n from g where f group by all having count(*) >= 4)
    select doc_id, count(*) as n_runs, max(n) as max_run, count(*) >= 3 as flagged from r group by doc_id"""
)
def verse_runs(spark, sf_dir):
    return lines.verse_runs(_t(spark, sf_dir, "documents"))


@query(
    f"""with l as (select *, sum((trim(line) = '')::int) over (partition by doc_id order by line_no) as g from {_lines_sql('documents')}),
    f as (select *, max(line_no) over (partition by doc_id, g) as last from l where trim(line) <> ''),
    b as (select doc_id, g, min(line_no)::int as first_line, count(*) as n_lines, max(length(line)) as longest,
    avg(case when line_no < last then length(line) end) as mean from f group by all)
    select doc_id, first_line, n_lines, case when n_lines < 2 then 'single' when longest > 90 then 'para' when mean >= 58 then 'prose' else 'verse' end as class from b"""
)
def block_classes(spark, sf_dir):
    return lines.block_classes(_t(spark, sf_dir, "documents"))


@query(
    """select doc_id, coalesce(list_sort([length(x) for x in string_split(text, chr(10)) if trim(x) <> ''])[
    floor(len([x for x in string_split(text, chr(10)) if trim(x) <> '']) * 0.85)::int + 1], 60)::int as width from documents"""
)
def column_width(spark, sf_dir):
    filled = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    return _t(spark, sf_dir, "documents").select("doc_id", T.width_at(F.transform(filled, F.length)).alias("width"))


@query(
    f"""with l as (select doc_id, line_no, rtrim(line, chr(32) || chr(9)) as line from {_lines_sql('documents')}),
    n as (select *, lead(line) over (partition by doc_id order by line_no) as nxt from l)
    select doc_id, md5(string_agg(line || case when line <> '' and nxt <> '' then '  ' else '' end, chr(10) order by line_no)) as digest from n group by doc_id"""
)
def hard_breaks(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(lines.hard_breaks(F.col("text")).cast("binary")).alias("digest"))


@query("select doc_id, md5(array_to_string([x for x in string_split(text, chr(10)) if trim(x) <> ''], chr(10) || chr(10))) as digest from documents")
def versify(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(lines.versify(F.col("text")).cast("binary")).alias("digest"))


@query(
    f"""with l as (select *, lag(trim(line)) over (partition by doc_id order by line_no) as b from {_lines_sql('documents')})
    select doc_id, md5(string_agg(line, chr(10) order by line_no)) as digest from l where trim(line) = '' or b is null or b <> trim(line) group by doc_id"""
)
def dedupe_adjacent(spark, sf_dir):
    return lines.drop_adjacent_repeats(_t(spark, sf_dir, "documents")).select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("select doc_id, true as same from documents")
def whitespace_invariance(spark, sf_dir):
    after = T.without_space(lines.hard_breaks(F.col("text")))
    return _t(spark, sf_dir, "documents").select("doc_id", (T.without_space(F.col("text")) == after).alias("same"))


@query(
    """select doc_id, len(regexp_extract_all(text, '[\\x{00C0}-\\x{024F}]')) as n_marked, len(regexp_extract_all(text, '\\p{L}')) as n_letters,
    len(regexp_extract_all(text, '[\\x{00C0}-\\x{024F}]')) / len(regexp_extract_all(text, '\\p{L}')) as share from documents where regexp_matches(text, '\\p{L}')"""
)
def script_share(spark, sf_dir):
    n = T.script_count(F.col("text"), [(0x00C0, 0x024F)])
    letters = T.count_matches(F.col("text"), r"\p{L}")
    return _t(spark, sf_dir, "documents").select("doc_id", n.alias("n_marked"), letters.alias("n_letters")).where("n_letters > 0").withColumn(
        "share", F.col("n_marked") / F.col("n_letters")
    )


_BLOCK = T.block_class([(0x00C0, 0x024F)])


@query(
    f"""with c as (select doc_id, length(text) as size, {_count(_BLOCK)} as n from documents where lang in ('fr', 'de'))
    select doc_id, case when n < 50 then 'S001' else 'S002' end as code, case when n < 50 then 'error' else 'warn' end as severity, n::bigint as n
    from c where n < 50 or (n < 0.05 * size and n < 500)"""
)
def script_rules(spark, sf_dir):
    return rules.script_rules(_t(spark, sf_dir, "documents"), {"fr": [(0x00C0, 0x024F)], "de": [(0x00C0, 0x024F)]})


@query(
    f"select lang, count(*) as n_docs, sum(len([x for x in regexp_split_to_array(text, {_q(T.SPACE_CLASS + '+')}) if x <> '']))::bigint as n_words, sum(strlen(text))::bigint as size_bytes from documents group by lang"
)
def index_header(spark, sf_dir):
    return _t(spark, sf_dir, "documents").groupBy("lang").agg(
        F.count("*").alias("n_docs"), F.sum(T.token_count(F.col("text"))).alias("n_words"), F.sum(F.octet_length("text")).alias("size_bytes")
    )


@query(f"select page_id as doc_id, substr(t, 1, 40) as tag, count(*) as n from (select page_id, unnest(regexp_extract_all(html, {_q(rules.KNOWN_TAG)})) as t from pages) group by all")
def html_tag_counts(spark, sf_dir):
    return rules.tag_counts(_t(spark, sf_dir, "pages").withColumnRenamed("page_id", "doc_id"), "html")


@query(
    f"""select doc_id, lower(t) as name, count(*) as n from (select doc_id, unnest(regexp_extract_all(text, {_q(rules.TAG)}, 1)) as t from {INJECTED})
    where not list_contains({_list(rules.ELEMENTS)}, lower(t)) group by all"""
)
def unknown_tags(spark, sf_dir):
    return rules.unknown_tags(_injected(spark, sf_dir))


def _steps_sql(text: str, steps) -> str:
    for pattern, replacement in steps:
        text = f"regexp_replace({text}, {_q(pattern)}, {_q(replacement.replace('$1', chr(92) + '1'))}, 'g')"
    return text


def _entities_sql(text: str) -> str:
    for a, b in markup.ENTITIES:
        text = f"replace({text}, {_q(a)}, {_q(b)})"
    return text


#: Headings: marks are set around them, and the pieces between the marks are looked at one by one.
_HEADED_SQL = f"""array_to_string([case when regexp_matches(x, '(?is)^<h[1-6][^>]*>.*</h[1-6]>$') and lower(x[3]) = lower(x[-2]) then chr(10) || chr(10) || repeat('#', x[3]::int) || ' '
    || trim(regexp_replace(regexp_replace(regexp_replace(x, '(?is)^<h[1-6][^>]*>', ''), '(?is)</h[1-6]>$', ''), '<[^>]+>|\\n', '', 'g')) || chr(10) || chr(10) else x end for x in
    string_split(regexp_replace(regexp_replace({_steps_sql('html', markup.CHROME_STEPS)}, '(?i)(<h[1-6][^>]*>)', chr(1) || '\\1', 'g'), '(?i)(</h[1-6]>)', '\\1' || chr(1), 'g'), chr(1))], '')"""


@query(f"select page_id, md5({_steps_sql(_entities_sql(_steps_sql('t', markup.INLINE_STEPS + markup.BLOCK_STEPS)), markup.TIDY_STEPS)}) as digest from (select page_id, {_HEADED_SQL} as t from pages)")
def html_to_markdown(spark, sf_dir):
    return elements.pages_to_markdown(_t(spark, sf_dir, "pages")).select("page_id", F.md5(F.col("markdown").cast("binary")).alias("digest"))


#: Tokens of the articles of pages, cut into parts at blocks.
_EVENTS_SQL = f"""with t as (
    select page_id, unnest(l) as tok, unnest(range(len(l))) as pos from (select page_id, regexp_extract_all(html, {_q(elements.TOKEN)}) as l from pages)
), k as (
    select *, lower(regexp_extract(tok, '^</?([A-Za-z][A-Za-z0-9:-]*)', 1)) as tag, tok like '</%' as closes from t where not regexp_matches(tok, '(?is)^<(?:[!?]|script\\b|style\\b)')
), c as (
    select *, sum(case when tag <> 'article' then 0 when closes then -1 else 1 end) over (partition by page_id order by pos) as d from k
), e as (
    select *, sum((tag in ('p', 'li', 'ul', 'ol', 'table', 'h1', 'h2', 'h3', 'h4', 'h5', 'h6'))::int) over w as part,
        coalesce(last_value(case when tag in ('li', 'ul', 'ol') then tag = 'li' and not closes end ignore nulls) over w, false) as item,
        coalesce(last_value(case when regexp_matches(tag, '^h[1-6]$') then case when closes then 0 else tag[2]::int end end ignore nulls) over w, 0) as head,
        case when tag = '' then {_entities_sql('tok')} when tag in ('i', 'em') then '*' when tag in ('b', 'strong') then '**' when tag = 'br' then chr(10) end as piece
    from c where d > 0 window w as (partition by page_id order by pos)
), g as (
    select page_id, part, min(pos) as pos, string_agg(piece, '' order by pos) as joined, arg_min(item, pos) filter (piece is not null) as item, arg_min(head, pos) filter (piece is not null) as head
    from e group by page_id, part having count(piece) > 0
), s as (
    select page_id, pos, item, head, regexp_replace(regexp_replace(joined, '[ \\t\\x{{A0}}]+', ' ', 'g'), '^[ \\t\\n\\f\\r\\v]+|[ \\t\\n\\f\\r\\v]+$', '', 'g') as payload from g
), n as (
    select page_id, row_number() over (partition by page_id order by pos)::int as n, case when head > 0 then 'heading' when item then 'item' else 'prose' end as kind,
        case when head > 0 then repeat('#', head) || ' ' || regexp_replace(payload, '\\s+', ' ', 'g') else payload end as payload from s where payload <> ''
)"""


def _article_events(spark, sf_dir):
    return elements.events(_t(spark, sf_dir, "pages"), content=lambda tag, token: tag == "article")


@query(f"{_EVENTS_SQL} select page_id, n, kind, md5(payload) as digest from n")
def page_events(spark, sf_dir):
    return _article_events(spark, sf_dir).select("page_id", "n", "kind", F.md5(F.col("payload").cast("binary")).alias("digest"))


@query(f"{_EVENTS_SQL} select page_id, kind, count(*) as n_events from n group by all")
def event_counts(spark, sf_dir):
    return _article_events(spark, sf_dir).groupBy("page_id", "kind").agg(F.count("*").alias("n_events"))


@query(
    f"""{_EVENTS_SQL}, b as (select page_id, n, kind, case when kind = 'item' then '- ' || payload else payload end as text from n)
    select page_id, row_number() over (partition by page_id order by n)::int as n, kind, md5(text) as digest from b where text = '* * *' or not regexp_matches(text, '^[*\\s]+$')"""
)
def event_blocks(spark, sf_dir):
    return elements.event_blocks(_article_events(spark, sf_dir)).select("page_id", "n", "kind", F.md5(F.col("text").cast("binary")).alias("digest"))


@query(
    """select page_id, (unnest(range(len(l))) + 1)::int as n, md5(unnest(l)) as digest from (
        select page_id, regexp_extract_all(html, '(?is)<li(?:[^>"]|"[^"]*")*>(.*?)</li>', 1) as l from pages)"""
)
def page_items(spark, sf_dir):
    items = elements.extract_elements(_t(spark, sf_dir, "pages"), lambda tag, token: tag == "li", inner=True)
    return items.select("page_id", "n", F.md5(F.col("html").cast("binary")).alias("digest"))


WIKI = [
    "{{header|title={{x}}}}\n== One ==\n'''Bold''' and ''it'' [[Page|shown]] [[Plain]]<ref name=a>gone</ref>",
    "<poem>a\nb</poem>\n=== Two ===\n[[Category:C]]<!-- c -->end",
]


@query(
    "select doc_id, md5("
    + _steps_sql(_steps_sql(_steps_sql(f"({_list(WIKI)}[doc_id % 2 + 1] || chr(10) || translate(text, '{{}}[]|=' || chr(39), ''))", [(r"\{\{[^{}]*\}\}", "")] * 2), markup.WIKI_STEPS), markup.TIDY_STEPS)
    + ") as digest from documents"
)
def wikitext_to_markdown(spark, sf_dir):
    head = F.element_at(F.array(*map(F.lit, WIKI)), (F.col("doc_id") % 2 + 1).cast("int"))
    source = F.concat(head, F.lit("\n"), F.translate("text", "{}[]|='", ""))
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(markup.wikitext_to_markdown(source).cast("binary")).alias("digest"))


#: The older of two snapshots: some ids are missing, some have another text.
_OLD = "(select doc_id, case when doc_id % 7 = 1 then text || '.' else text end as text from documents where doc_id % 10 <> 3)"
_NEW = "(select doc_id, text from documents where doc_id % 11 <> 5)"


@query(
    f"""with a as (select doc_id as id_a, sha256(text) as h_a from {_OLD}), b as (select doc_id as id_b, sha256(text) as h_b from {_NEW}),
    j as (select * from a full join b on id_a = id_b), gone as (select distinct h_a from j where id_b is null)
    select coalesce(id_a, id_b) as doc_id, case when id_a is null and h_b in (select h_a from gone) then 'renamed' when id_a is null then 'added'
    when id_b is null then 'removed' else 'edited' end as change from j where id_a is null or id_b is null or h_a <> h_b"""
)
def snapshot_diff(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.when(F.col("doc_id") % 7 == 1, F.concat("text", F.lit("."))).otherwise(F.col("text"))
    old = docs.where("doc_id % 10 <> 3").select("doc_id", text.alias("text"))
    return relations.snapshot_diff(old, docs.where("doc_id % 11 <> 5"))


#: Headers of files by turns: whole, never closed, without a field, none; a seventh of the files is cut inside a character.
FILE_HEADERS = ["title: t\nauthor: a\nyear: 1\nsource: s\nlicense: l\n---\n", "title: t\n", "title: t: u\nauthor: a\nyear: 1\nsource: s\n---\n", ""]
_RAW_SQL = f"case when doc_id % 4 = 3 then text else '---' || chr(10) || 'language: ' || lang || chr(10) || {_list(FILE_HEADERS)}[doc_id % 4 + 1] || text end"
_FILES_SQL = f"""(select doc_id, lang, raw, case when doc_id % 4 in (0, 2) then text else raw end as text from (select doc_id, lang, text, {_RAW_SQL} as raw from documents where doc_id % 7 <> 0))"""


def _files(spark, sf_dir) -> DataFrame:
    turn = F.element_at(F.array(*map(F.lit, FILE_HEADERS)), (F.col("doc_id") % 4 + 1).cast("int"))
    raw = F.when(F.col("doc_id") % 4 == 3, F.col("text")).otherwise(F.concat(F.lit("---\nlanguage: "), "lang", F.lit("\n"), turn, "text"))
    cut = F.when(F.col("doc_id") % 7 == 0, F.unhex(F.lit("C3"))).otherwise(F.lit(b""))
    return _t(spark, sf_dir, "documents").select("doc_id", F.concat(raw.cast("binary"), cut).alias("content"))


def _file_issues(spark, sf_dir) -> DataFrame:
    latin = [(0x00C0, 0x024F)]
    stated = _t(spark, sf_dir, "documents").select("doc_id", F.format_string("%d books", "doc_id").alias("text")).where("doc_id < 50")
    known = _t(spark, sf_dir, "documents").agg(F.lit("books").alias("quantity"), F.count_if(F.col("doc_id") < 10).alias("n"))
    return reports.file_issues(_files(spark, sf_dir), blocks={"fr": latin, "de": latin}, stated=stated, derived=known)


_SCRIPT_SQL = f"""(select doc_id, case when n < 50 then 'S001' else 'S002' end as code, case when n < 50 then 'error' else 'warn' end as severity, n
    from (select doc_id, length(text) as size, {_count(_BLOCK)} as n from {_FILES_SQL} where lang in ('fr', 'de') and doc_id % 4 in (0, 2)) where n < 50 or (n < 0.05 * size and n < 500))"""
_FILE_ISSUES_SQL = f"""(select doc_id, 'lint' as class, code, severity, sum(n)::bigint as n from (
        select doc_id, code, severity, n from {_rules_sql(_FILES_SQL)} union all select doc_id, code, severity, 1 from {_SCRIPT_SQL}
        union all select doc_id, 'E001', 'error', 1 from documents where doc_id % 7 = 0 union all select doc_id, 'FM001', 'error', 1 from documents where doc_id % 4 = 3 and doc_id % 7 <> 0
        union all select doc_id, 'FM002', 'error', 1 from documents where doc_id % 4 = 1 and doc_id % 7 <> 0 union all select doc_id, 'FM003', 'warn', 1 from documents where doc_id % 4 = 2 and doc_id % 7 <> 0
        union all select doc_id, 'FM005', 'error', 1 from documents where doc_id % 4 = 2 and doc_id % 7 <> 0) group by all
    union all select doc_id, 'verse', 'D1', 'warn', count(*) from (
        select doc_id, g, count(*) as k from (select *, sum((not f)::int) over (partition by doc_id order by line_no) as g from (select *, {_SUSPECT} as f from {_lines_sql(_FILES_SQL)})) where f group by all having count(*) >= 4
    ) group by doc_id having count(*) >= 3
    union all select doc_id, 'counts', 'D3', 'error', 1 from documents where doc_id < 50 and doc_id <> (select count(*) from documents where doc_id < 10))"""


@query(f"select * from {_FILE_ISSUES_SQL}")
def file_issues(spark, sf_dir):
    return _file_issues(spark, sf_dir)


@query(f"select doc_id, case when bool_or(severity = 'error') then 'blocked' else 'advisory' end as status from {_FILE_ISSUES_SQL} group by doc_id")
def gate_status(spark, sf_dir):
    return reports.gate_status(_file_issues(spark, sf_dir))


@query(f"select class, severity, count(distinct doc_id) as n_docs, sum(n)::bigint as n from {_FILE_ISSUES_SQL} group by all")
def gate_summary(spark, sf_dir):
    return reports.gate_summary(_file_issues(spark, sf_dir))


@query(
    """with w as (select doc_id, list_distinct(regexp_extract_all(text, '([A-Za-z]+)\\. ', 1)) as l from documents)
    select doc_id as unit, key, 'undefined' as problem from (select doc_id, unnest(l) as key from w) where length(key) < 5"""
)
def note_mismatches(spark, sf_dir):
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(r"([A-Za-z]+)\. "), F.lit(1)))
    defined = F.array_join(F.transform(F.filter(words, lambda w: F.length(w) > 4), lambda w: F.concat(F.lit("\n[^"), w, F.lit("]: of "), w)), "")
    docs = _t(spark, sf_dir, "documents")
    units = docs.select(F.col("doc_id").alias("unit"), F.concat(F.regexp_replace("text", r"([A-Za-z]+)\. ", "$1[^$1]. "), defined).alias("text"))
    return layout.note_mismatches(units)


@query("select doc_id, md5(regexp_replace(text, '([a-z])([a-z]+), ', chr(10) || chr(10) || '```' || chr(10) || '\\1 = \\2' || chr(10) || '```' || chr(10) || chr(10), 'g')) as digest from documents")
def drawn_formulas(spark, sf_dir):
    drawn = F.regexp_replace("text", "([a-z])([a-z]+), ", "\n\n    $1 = $2\n\n")
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(layout.fence_formulas(drawn).cast("binary")).alias("digest"))


@query(
    """with l as (select doc_id, unnest(string_split(replace(text, '. ', '.' || chr(10) || '　'), chr(10))) as x, unnest(range(len(string_split(replace(text, '. ', '.' || chr(10) || '　'), chr(10))))) as i from documents),
    b as (select doc_id, i, x, trim(x, '　 ' || chr(9)) as w from l),
    p as (select doc_id, string_agg(case when w = '' then chr(10) || chr(10) when starts_with(w, '#') then chr(10) || chr(10) || w || chr(10) || chr(10) when starts_with(x, '　') then chr(10) || chr(10) || w else w end, '' order by i) as t from b group by doc_id)
    select doc_id, md5(regexp_replace(regexp_replace(t, '\\n{3,}', chr(10) || chr(10), 'g'), '^\\n+|\\n+$', '', 'g')) as digest from p"""
)
def indented_paragraphs(spark, sf_dir):
    marked = F.replace("text", F.lit(". "), F.lit(".\n　"))
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(layout.indent_paragraphs(marked).cast("binary")).alias("digest"))


@query(
    """with b as (select conv_id as section, turn as place, (turn - (turn % 4 = 3)::int)::int as number from conversations),
    l as (select *, lag(number) over (partition by section order by place) as before from b)
    select section, place, number, before, case when number > coalesce(before, -1) + 1 then 'gap' when number = before then 'repeat' when number = 0 and before is not null then 'reset' else 'back' end as problem
    from l where number <> coalesce(before, -1) + 1"""
)
def sequence_breaks(spark, sf_dir):
    number = (F.col("turn") - (F.col("turn") % 4 == 3).cast("int")).cast("int")
    rows = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("section"), F.col("turn").alias("place"), number.alias("number"))
    return layout.sequence_breaks(rows, first=0)


@query(
    """with f as (select source as section, count(*) as n from documents where lang <> 'en' or source < 's' group by source), s as (select distinct source from documents)
    select coalesce(f.section, d.section) as section, n, low, high, case when n is null then 'missing' when n < low then 'short' else 'long' end as problem
    from f full join (select source as section, 20 as low, 40 as high from s union all select 'none', 1, null) d on f.section = d.section where n is null or n < low or n > high"""
)
def count_violations(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    found = docs.where("lang <> 'en' or source < 's'").groupBy(F.col("source").alias("section")).agg(F.count("*").alias("n"))
    declared = docs.select(F.col("source").alias("section")).distinct().select("section", F.lit(20).alias("low"), F.lit(40).alias("high"))
    return layout.count_violations(found, declared.union(spark.range(1).select(F.lit("none"), F.lit(1), F.lit(None))))


#: Characters by the accents in their Unicode names.
_ACCENTS = layout.named_class("CIRCUMFLEX", "CEDILLA"), layout.named_class("ACUTE", "GRAVE")


@query(f"select doc_id, {_count(_ACCENTS[0])} as n_first, {_count(_ACCENTS[1])} - {_count('[ẤẦấầẾẾếềỐỒốồḈḉ]')} as n_second from documents")
def accent_counts(spark, sf_dir):
    found = layout.accent_counts(F.col("text"), *_ACCENTS)
    return _t(spark, sf_dir, "documents").select("doc_id", found["polytonic"].alias("n_first"), found["tonos"].alias("n_second"))


@query()
def columnar_tables(spark, sf_dir):
    head = F.concat(F.lit("\n\n    Word.       Second.     Third.\n    "), F.regexp_replace("text", r"(?s)^(\S+)\s+(\S+)\s+(\S+)\s.*", "$1     $2     $3"), F.lit("\n\n"))
    return layout.columnar_tables(_t(spark, sf_dir, "documents").select("doc_id", F.concat("text", head).alias("text")))


@query(
    """with p as (select doc_id, string_split(replace(text, chr(10), ' '), '. ') as l from documents),
    i as (select doc_id, unnest(l) as x, unnest(range(len(l))) as i, len(l) as k from p),
    n as (select *, (i + 1)::int as stanza, (i + 1 + 5 * (i % 10 = 4)::int)::int as stated, i % 10 = 4 and i + 1 < k as misread from i),
    v as (select *, case when misread then stanza else stated end as number from n)
    select doc_id, stanza, number, stated, md5(trim(regexp_replace(x, '\\s+$', '')) || ' (' || number || ')') as digest,
        array_to_string(list_filter([case when misread then 'misread' end, case when number <> stanza then 'jump' end], lambda x: x is not null), ',') as problems from v"""
)
def numbered_stanzas(spark, sf_dir):
    number = lambda i: i + 1 + F.when(i % 10 == 4, 5).otherwise(0)
    parts = F.split(F.replace("text", F.lit("\n"), F.lit(" ")), r"\. ")
    lined = F.array_join(F.transform(parts, lambda x, i: F.concat(x, F.lit(" "), number(i).cast("string"))), "\n")
    found = layout.numbered_stanzas(_t(spark, sf_dir, "documents").select("doc_id", lined.alias("text")), r"^(.*?)\s+([0-9]+)$", n_lines=1)
    return found.select("doc_id", "stanza", "number", "stated", F.md5(F.col("text").cast("binary")).alias("digest"), F.array_join("problems", ",").alias("problems"))


@query(
    """with h as (select lang, count(*) as books from documents group by lang), c as (select source as family, list_sort(list_distinct(list(lang))) as locales, max(doc_id) as n from documents where doc_id < 40 group by source),
    r as (select family, n, unnest(list_concat(locales, [family])) as locale from c), j as (select *, row_number() over (partition by locale order by family) as i from r left join h on lang = locale)
    select family, null as locale, 'count' as problem from j group by family, n having n <> coalesce(sum(books), 0) union all select family, locale, 'unknown' from j where books is null
    union all select family, locale, 'twice' from j where books is not null and i > 1 union all select null, lang, 'missing' from h where lang not in (select locale from r)"""
)
def locale_counts(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    rows = docs.where("doc_id < 40").groupBy(F.col("source").alias("family")).agg(F.concat(F.array_sort(F.collect_set("lang")), F.array(F.first("source"))).alias("locales"), F.max("doc_id").alias("n"))
    return publish.locale_counts(docs.select(F.col("lang").alias("locale")), rows)


#: Snapshots with new ids for a third of the texts, half of those reworked by a line at their end.
_OLD_SQL = "select doc_id, text from documents where doc_id % 10 <> 3"
_NEW_SQL = """select case when doc_id % 3 = 0 then doc_id + 1000000 else doc_id end as doc_id,
    case when doc_id % 6 = 0 then text || chr(10) || 'a line of its own' else text end as text from documents where doc_id % 11 <> 5"""


def _moved_snapshots(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    came = docs.where("doc_id % 11 <> 5").select(
        F.when(F.col("doc_id") % 3 == 0, F.col("doc_id") + 1000000).otherwise(F.col("doc_id")).alias("doc_id"),
        F.when(F.col("doc_id") % 6 == 0, F.concat("text", F.lit("\na line of its own"))).otherwise(F.col("text")).alias("text"),
    )
    return docs.where("doc_id % 10 <> 3"), came


@query(
    f"""with o as ({_OLD_SQL}), n as ({_NEW_SQL}),
    a as (select doc_id, unnest(string_split(text, chr(10))) as line from o where doc_id not in (select doc_id from n)),
    b as (select doc_id, unnest(string_split(text, chr(10))) as line from n where doc_id not in (select doc_id from o)),
    x as (select doc_id, line, sum(strlen(line) + 1) as w from a group by doc_id, line), y as (select doc_id, line, sum(strlen(line) + 1) as w from b group by doc_id, line),
    sx as (select doc_id, sum(w) as s from x group by doc_id), sy as (select doc_id, sum(w) as s from y group by doc_id),
    p as (select x.doc_id as old, y.doc_id as new, sum(least(x.w, y.w)) as common from x join y using (line) group by all)
    select old, new, (60000 * common // greatest(sx.s, sy.s))::bigint as score from p join sx on sx.doc_id = old join sy on sy.doc_id = new where 2 * common >= greatest(sx.s, sy.s)"""
)
def rename_scores(spark, sf_dir):
    old, new = _moved_snapshots(spark, sf_dir)
    return renames.rename_scores(old.join(new, "doc_id", "left_anti"), new.join(old, "doc_id", "left_anti"))


@query()
def snapshot_changes(spark, sf_dir):
    return renames.snapshot_changes(*_moved_snapshots(spark, sf_dir))


def _as_books(spark, sf_dir):
    header = F.create_map(F.lit("title"), F.substring("text", 1, 20), F.lit("author"), F.col("source"), F.lit("language"), F.col("lang"), F.lit("year"), (F.col("doc_id") % 2100).cast("string"), F.lit("note"), F.lit('a "note"'))
    path = F.concat(F.lit("books/"), "lang", F.lit("/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md"))
    return _t(spark, sf_dir, "documents").select(path.alias("path"), F.col("lang").alias("locale"), header.alias("header"), F.octet_length("text").alias("size_bytes"), "text")


_PAIR = "'      \"{0}\": ' || to_json({1})"


@query(
    """with b as (
        select 'books/' || lang || '/' || source || '/' || doc_id || '.md' as path, lang, source, text, doc_id from documents
    ), f as (select count(*) as n, list_sort(list_distinct(list(lang))) as locales, max(path) as last from b)
    select 1 as rank, path, md5('    {' || chr(10) || array_to_string(["""
    + ", ".join(
        _PAIR.format(k, v)
        for k, v in {"path": "path", "locale": "lang", "title": "substr(text, 1, 20)", "author": "source", "language": "lang", "year": "(doc_id % 2100)::varchar", "note": "'a \"note\"'"}.items()
    )
    + """,
        '      "yearNumeric": ' || doc_id % 2100, '      "sizeBytes": ' || strlen(text),
        '      "wordCount": ' || len(list_filter(regexp_split_to_array(text, '[\\x09-\\x0D\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+'), lambda x: x <> ''))
        ], ',' || chr(10)) || chr(10) || '    }' || case when path < last then ',' else '' end) as digest from b, f
    union all select 0, '', md5('{' || chr(10) || '  "corpus": "documents",' || chr(10) || '  "bookCount": ' || n || ',' || chr(10) || '  "localeCount": ' || len(locales) || ',' || chr(10) || '  "locales": [' || chr(10)
        || array_to_string(['    ' || to_json(x) for x in locales], ',' || chr(10)) || chr(10) || '  ],' || chr(10) || '  "books": [') from f
    union all select 2, '', md5('  ]' || chr(10) || '}')"""
)
def manifest_rows(spark, sf_dir):
    rows = ordered.manifest_rows(_as_books(spark, sf_dir), {"corpus": "documents"})
    return rows.select("rank", "path", F.md5(F.col("text").cast("binary")).alias("digest"))


@query(
    """with i as (select *, case when n_chars < 60 then 'short' when contains(text, '###') then 'marked' end as reason from documents),
    k as (select *, row_number() over (order by lang, source, doc_id) as n, row_number() over (partition by lang order by source, doc_id) as m from i where reason is null)
    select 1 as rank, lang, source, doc_id, md5(case when n = 1 then '' else chr(10) end || case when m = 1 then '# ' || lang || chr(10) || chr(10) else '' end || '## Text ' || doc_id
        || case when source <> '' then chr(10) || chr(10) || '*' || source || '*' else '' end || case when text <> '' then chr(10) || chr(10) || text else '' end) as digest from k
    union all select 0, null, null, null, md5(count(*) filter (reason is null) || ' of ' || count(*) || ', ' || count(*) filter (reason = 'short') || ' short, ' || count(*) filter (reason = 'marked') || ' marked') from i"""
)
def anthology_rows(spark, sf_dir):
    items = _t(spark, sf_dir, "documents").select("lang", "source", "doc_id", "n_chars", F.concat(F.lit("Text "), F.col("doc_id").cast("string")).alias("title"), F.col("source").alias("cite"), "text")
    exclude = {"short": F.col("n_chars") < 60, "marked": F.col("text").contains("###")}
    rows = ordered.anthology_rows(items, ["lang", "source", "doc_id"], exclude, "{kept} of {total}, {short} short, {marked} marked", section="lang", nameless=True)
    # a heading without a name has no digest, as in SQL
    unnamed = (F.col("rank") == 1) & F.col("lang").isNull() & F.col("text").rlike("^\n?# ")
    return rows.select("rank", "lang", "source", "doc_id", F.when(~unnamed, F.md5(F.col("text").cast("binary"))).alias("digest"))


@query(
    """select doc_id, m as mark, length(text) - length(replace(text, m, '')) as n_source, (length(c) - length(replace(c, m, '')))::bigint as n_copy,
    m = '«' or length(c) - length(replace(c, m, '')) >= length(text) - length(replace(text, m, '')) as ok
    from (select doc_id, text, regexp_replace(text, '[.,][^.]*$', '') as c, unnest(['.', ',', '«']) as m from documents) where contains(text, m)"""
)
def mark_drops(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    copy = docs.select("doc_id", F.regexp_replace("text", r"[.,][^.]*$", "").alias("text"))
    return relations.mark_drops(docs, copy, ".,«", rendered={"«"})


STATED = [("en", 1), ("fr", 2), ("xx", 3), ("en", 4)]


@query(
    "with s(locale, n) as (values " + ", ".join(f"('{a}', {b})" for a, b in STATED) + """), c as (select locale, sum(n) as n, count(*) as times from s group by 1),
    h as (select lang as locale, count(*) as have from documents group by 1)
    select locale, case when have is null then 'unknown' when n is null then 'missing' when times > 1 then 'duplicate' else 'mismatch' end as problem
    from c full join h using (locale) where have is null or n is null or times > 1 or n <> have"""
)
def coverage_check(spark, sf_dir):
    stated = spark.createDataFrame(STATED, "locale string, n long")
    return relations.coverage(stated, _t(spark, sf_dir, "documents").withColumnRenamed("lang", "locale"))


_HEAD = "---\ntitle: {}\nauthor: A\nlanguage: {}\nyear: {}\nsource: S\n"
HEADERS = [
    _HEAD.format("T", "en", "1915") + "license: L\n---\n\n",
    _HEAD.format("A: B", "no", "c. 500") + "---\n",
    _HEAD.format('"A: B"', "en", '"c. 399 BCE"') + "license: L\nnever closed",
    "no header\n",
    _HEAD.format("T:", "~", "'1800'") + "license: L\n---\n",
    _HEAD.format("T", "en", "-399") + "licence: L\nnote: yes\n---\n---\n",
]


def _headed(spark, sf_dir) -> DataFrame:
    """Documents below headers by turns."""
    raw = F.element_at(F.array(*map(F.lit, HEADERS)), (F.col("doc_id") % len(HEADERS) + 1).cast("int"))
    return _t(spark, sf_dir, "documents").select("doc_id", "lang", F.concat(raw, F.col("text")).alias("raw"))


HEADED = f"(select doc_id, lang, {_list(HEADERS)}[doc_id % {len(HEADERS)} + 1] || text as raw from documents)"
_HEADER_SQL = f"""(select doc_id, raw, starts_with(raw, '---' || chr(10)) as opened, regexp_extract(raw, '(?s)^---\\n(.*?)\\n---\\n', 1) as header,
    regexp_matches(raw, '(?s)^---\\n.*?\\n---\\n') as closed from {HEADED})"""
_HEADER_LINES = f"""(select doc_id, line, regexp_extract(x, '^[A-Za-z_][A-Za-z0-9_-]*:\\s+(\\S.*)$', 1) as v from
    (select doc_id, unnest(range(2, len(ls) + 2)) as line, unnest(ls) as x from (select doc_id, string_split(header, chr(10)) as ls from {_HEADER_SQL} where closed)))"""


@query(
    f"""select doc_id, 'FM001' as code, 'error' as severity, 1 as line, 1::bigint as n from {_HEADER_SQL} where not opened
    union all select doc_id, 'FM002', 'error', 1, 1 from {_HEADER_SQL} where opened and not closed
    union all select doc_id, 'FM003', 'warn', 1, n from (select doc_id, {' + '.join(f"(not regexp_matches(header, '(?m)^{k}:'))::int" for k in rules.REQUIRED)} as n from {_HEADER_SQL} where closed) where n > 0
    union all select doc_id, 'FM004', 'warn', 1, 1 from (select doc_id, regexp_extract(header, '(?m)^year: *(.+)$', 1) as y from {_HEADER_SQL} where closed) where not regexp_matches(y, '^-?[0-9]+$') and y[1] <> '"'
    union all select doc_id, 'FM005', 'error', line::int, 1 from {_HEADER_LINES} where v[1] not in ('"', chr(39)) and (contains(v, ': ') or ends_with(v, ':'))
    union all select doc_id, 'FM006', 'error', line::int, 1 from {_HEADER_LINES} where list_contains({_list(rules.COERCED)}, lower(v))"""
)
def frontmatter_rules(spark, sf_dir):
    return rules.header_rules(_headed(spark, sf_dir))


_ROUTE = "---\nlanguage: {}\nsacred_text: {}\n{}---\n"
ROUTED = [
    _ROUTE.format("cop", "other", ""),
    _ROUTE.format("cop", "recovered-text", ""),
    _ROUTE.format("cop", '"recovered-text"', "source_note: >-\n  folded\n"),
    _ROUTE.format("cop", "recovered-text", 'source_note: "found again"\n'),
    _ROUTE.format("cop", "sole-witness", "source_note: sole-witness\n"),
    _ROUTE.format("cop", "sole-witness", "source_note: sole-witness, ISO 15924 Copt, sources/a.md\n"),
    _ROUTE.format("cop", "sole-witness", "source_note: sole-witness, ISO 15924 Copt, sources/b.md\n"),
    _ROUTE.format("cop", "sole-witness", "source_note: sole-witness, ISO 15924 Copt, sources/c.md\n"),
    "---\nlanguage: en\n---\n",
]
RECORDS = [("a.md", "script `Copt` and locale `cop`"), ("b.md", "script Copt and `co`")]
_WRONG = [["route"], ["note"], ["block"], ["unnamed"], ["script", "citation"], [], ["record script", "record locale"], ["record"], []]


@query(
    f"""select doc_id, 'FM007' as code, 'error' as severity, 1 as line, unnest([{', '.join(_list(x) for x in _WRONG)}][doc_id % {len(ROUTED)} + 1]) as detail
    from documents where not starts_with(text, '---')"""
)
def admission_routes(spark, sf_dir):
    header = F.element_at(F.array(*map(F.lit, ROUTED)), (F.col("doc_id") % len(ROUTED) + 1).cast("int"))
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.concat(header, F.col("text")).alias("raw"))
    return rules.route_rule(docs, spark.createDataFrame(RECORDS, "name string, text string"))


@query(
    """with c as (select 'books/' || lang || '/' || doc_id || '.md' as path, ['Copt', 'Goth', 'Ogam'][doc_id % 3 + 1] as script from documents where doc_id % 50 = 7),
    f as (select script, min(path) as first_path from c group by script) select path, script, first_path from c join f using (script) where path <> first_path"""
)
def sole_witnesses(spark, sf_dir):
    script = F.element_at(F.array(*map(F.lit, ["Copt", "Goth", "Ogam"])), (F.col("doc_id") % 3 + 1).cast("int"))
    route = F.when(F.col("doc_id") % 50 == 7, "sole-witness").otherwise("recovered-text")
    raw = F.concat(F.lit("---\nsacred_text: "), route, F.lit("\nsource_note: 'ISO 15924 "), script, F.lit("'\n---\n"), F.col("text"))
    path = F.concat(F.lit("books/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md"))
    return rules.sole_witness_rule(_t(spark, sf_dir, "documents").select(path.alias("path"), raw.alias("raw")))


YEARS = ["1915", "c. 1280", "c. 399 BCE", "1887-1906", " -399", "n.d."]


@query(
    f"""select doc_id, case when d <> '' then d::int * case when contains(t, 'BCE') or regexp_matches(t, '^\\s*-') then -1 else 1 end end as year_number
    from (select doc_id, t, regexp_extract(t, '[0-9]{{1,4}}') as d from (select doc_id, {_list(YEARS)}[doc_id % 6 + 1] || text as t from documents))"""
)
def year_numeric(spark, sf_dir):
    year = F.concat(F.element_at(F.array(*map(F.lit, YEARS)), (F.col("doc_id") % 6 + 1).cast("int")), F.col("text"))
    return _t(spark, sf_dir, "documents").select("doc_id", T.year_number(year).alias("year_number"))


@query(
    """with r as (select doc_id, 'books/' || lang || '/' || source || case when doc_id % 5 = 0 then '.txt' else '/' || doc_id || '.md' end as path from documents)
    select path, rule from (select path, unnest([case when doc_id % 13 = 0 then 'MS-1' end, case when doc_id % 17 = 0 then 'MS-2' end, case when doc_id % 5 = 0 then 'MS-3' end,
    case when doc_id % 19 = 0 then 'MS-4' end, case when doc_id % 3 = 0 then 'MS-5' end, case when 1900 + doc_id % 50 > 1928 or doc_id % 23 = 0 then 'MS-6' end,
    case when doc_id % 29 = 0 or doc_id % 13 = 0 then 'MS-7' end, case when doc_id % 31 = 0 then 'MS-8' end, case when doc_id % 37 = 0 then 'MS-9' end, case when doc_id % 7 = 2 then 'MS-10' end]) as rule from r)
    where rule is not null"""
)
def index_violations(spark, sf_dir):
    every = lambda k, odd, plain, rest=0: F.when(F.col("doc_id") % k == rest, odd).otherwise(plain)
    number = F.col("doc_id").cast("string")
    fields = {
        "locale": F.col("lang"), "language": every(19, F.lit("english"), F.col("lang")), "title": every(3, F.lit(""), F.lit("t")), "author": F.lit("a"),
        "source": F.col("source"), "year": every(23, F.lit("ca 1900"), F.lit("c. 1900 CE")), "yearNumeric": (1900 + F.col("doc_id") % 50).cast("string"),
        "source_url": every(29, F.lit("http://x.example"), F.lit("https://x.example")), "license": every(31, F.lit("other"), F.lit(relations.LICENSE)),
        "sizeBytes": every(37, F.lit("-1"), F.octet_length("text").cast("string")), "wordCount": T.token_count(F.col("text")).cast("string"),
        "text_quality": every(7, F.lit("poor"), F.lit("noisy"), 2), "extra": F.lit("x"),
    }
    record = F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*fields.values()))
    record = F.map_filter(record, lambda k, v: ~((k == "extra") & (F.col("doc_id") % 17 != 0)) & ~((k == "source_url") & (F.col("doc_id") % 13 == 0)))
    path = F.concat(F.lit("books/"), "lang", F.lit("/"), "source", every(5, F.lit(".txt"), F.concat(F.lit("/"), number, F.lit(".md"))))
    return relations.index_violations(_t(spark, sf_dir, "documents").select(path.alias("path"), record.alias("record")))


@query("select count(*) as book_count, count(distinct lang)::int as locale_count, list_sort(list_distinct(list(lang))) as locales from documents")
def index_counts(spark, sf_dir):
    return relations.index_header(_t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("lang").alias("locale")))


@query("select source as name, 'MS-11' as rule from documents group by source having count(*) > count(distinct lang) or bool_or(doc_id % 100 = 1)")
def index_header_rules(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    headers = relations.index_headers(docs.select(F.col("source").alias("name"), F.col("lang").alias("locale")))
    odd = docs.where("doc_id % 100 = 1").select(F.col("source").alias("name"), F.lit(-1).cast("long").alias("_wrong")).distinct()
    return relations.header_violations(headers.join(odd, "name", "left").withColumn("book_count", F.coalesce("_wrong", "book_count")))


@query("select doc_id, source from (select doc_id, source, row_number() over (partition by source order by doc_id) as rn from documents) where rn > 1")
def unique_witness(spark, sf_dir):
    return relations.one_each(_t(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id")


@query("select source, min(doc_id) as doc_id, count(*) as n from documents group by source")
def first_by_source(spark, sf_dir):
    return _t(spark, sf_dir, "documents").groupBy("source").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))


@query("select min(doc_id) as doc_id, count(*) as n from documents group by text having count(*) > 1")
def duplicate_docs(spark, sf_dir):
    same = _t(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    return same.where("n > 1").select("doc_id", "n")


@query("select d.doc_id, lang, quality, toxic from documents d left join labels l using (doc_id)")
def quality_tier_join(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", "lang").join(_t(spark, sf_dir, "labels"), "doc_id", "left")


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def missing_labels(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id").join(_t(spark, sf_dir, "labels"), "doc_id", "left_anti")


@query("select doc_id from documents where doc_id in (select doc_id from labels where quality = 1)")
def labelled_good(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id").join(_t(spark, sf_dir, "labels").where("quality = 1"), "doc_id", "left_semi")


@query("select conv_id, count(*) as n, md5(string_agg(role || ': ' || text, chr(10) order by turn)) as digest from conversations group by conv_id")
def conversation_units(spark, sf_dir):
    units = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("turn", F.concat("role", F.lit(": "), "text").alias("t")))).alias("u")
    )
    return units.select("conv_id", "n", F.md5(F.array_join(F.transform("u", lambda x: x["t"]), "\n").cast("binary")).alias("digest"))


@query(
    f"""with l as (select doc_id, line_no from {_lines_sql('documents')} where length(line) < 40)
    select doc_id, line_no::int as line_no, (lead(line_no) over (partition by doc_id order by line_no))::int as next_boundary from l"""
)
def page_next_boundary(spark, sf_dir):
    return lines.short_lines(_t(spark, sf_dir, "documents"), 40)


@query(
    """select lang as engine, sum(length(regexp_replace(regexp_replace(text, '\\s', '', 'g'), '[0-9a-zA-Z]', '', 'g'))) / sum(length(regexp_replace(text, '\\s', '', 'g'))) as noise
    from documents group by lang"""
)
def base_engine_noise(spark, sf_dir):
    return relations.noise(_t(spark, sf_dir, "documents").select(F.col("lang").alias("engine"), "text"), "a-zA-Z")


@query()
def line_agreement(spark, sf_dir):
    pages = _t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("page_id"), F.regexp_replace("text", r"(?<=[.]) ", "\n").alias("text"))
    other = pages.select("page_id", F.regexp_replace("text", "th", "tb").alias("text"))
    return relations.agreement(relations.line_ratios(pages, other), "page_id")


@query(
    """select page_id, md5(regexp_replace(html, '(?is)<nav\\b[^>]*>.*?</nav\\s*>', '', 'g')) as digest from pages"""
)
def strip_balanced(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", F.md5(markup.strip_balanced("nav", "")("html").cast("binary")).alias("digest"))


@query()
def reflow_pages(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", markup.reflow()(F.array("text")).alias("text"))


@query(
    """select n_name, count(distinct o_orderkey) as n_orders, round(sum(l_extendedprice * (1 - l_discount))) as revenue from customer join orders on c_custkey = o_custkey
    join lineitem on l_orderkey = o_orderkey join nation on c_nationkey = n_nationkey group by n_name"""
)
def revenue_by_nation(spark, sf_dir):
    sales = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    orders = _t(spark, sf_dir, "orders").join(sales, F.col("o_orderkey") == F.col("l_orderkey"))
    named = orders.join(_t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        _t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return named.groupBy("n_name").agg(F.countDistinct("o_orderkey").alias("n_orders"), F.round(F.sum("r")).alias("revenue"))


def queries() -> dict:
    from . import catalogue_text  # noqa: F401  registers its queries

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
