"""Queries of scalar functions, transforms, publishing and relations over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalogue import _lines_sql, _list, _q, _t, HEADED, _headed, query
from .functions import text as T
from .operators import markup, publish, relations, transforms as X


def _digest(df, key, text):
    return df.select(key, F.md5(text.cast("binary")).alias("digest"))


def _docs(spark, sf_dir):
    return _t(spark, sf_dir, "documents")


_BODY = "case when n > 0 then substr(raw, n + 1) else raw end"
_HEAD_N = f"(select doc_id, raw, case when starts_with(raw, '---' || chr(10)) and strpos(substr(raw, 5), chr(10) || '---' || chr(10)) > 0 then strpos(substr(raw, 5), chr(10) || '---' || chr(10)) + 8 else 0 end as n from {HEADED})"


@query(
    f"""select doc_id, n::int as body_start, nullif(regexp_extract(substr(raw, 1, n), '(?m)^language:\\s*(\\S+)', 1), '') as locale,
    case when n > 0 then regexp_replace(trim(regexp_extract(substr(raw, 1, n), '(?m)^title:[ \\t]*(.*)$', 1)), '^"(.*)"$', '\\1') end as title, md5({_BODY}) as digest from {_HEAD_N}"""
)
def header_parts(spark, sf_dir):
    from .operators.rules import header_value

    head, body = X.split_header(F.col("raw"))
    return _headed(spark, sf_dir).select(
        "doc_id", X.body_start(F.col("raw")).alias("body_start"), X.header_locale(F.col("raw")).alias("locale"),
        header_value(head, "title").alias("title"), F.md5(body.cast("binary")).alias("digest"),
    )


#: Line ends and blanks that normalisation has to put right.
_ROUGH = "text || chr(13) || chr(10) || '  a  b' || chr(13) || chr(10) || chr(10) || chr(10) || chr(10) || 'c  ' || chr(10) || 'd   ' || chr(10) || 'e ' || chr(10) || chr(10)"
def _rough():
    return F.concat(F.col("text"), F.lit("\r\n  a  b\r\n\n\n\nc  \nd   \ne \n\n"))


@query(
    f"""select doc_id, md5(rtrim(regexp_replace(regexp_replace(replace(replace(t, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \\t]+\\n', chr(10), 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10)) || chr(10)) as digest
    from (select doc_id, {_ROUGH} as t from documents)"""
)
def normalize_newlines(spark, sf_dir):
    return _digest(_docs(spark, sf_dir), "doc_id", T.normalize_newlines(_rough()))


@query(
    f"""select doc_id, md5(trim(string_agg(case when regexp_matches(l, '[^ ]  $') and nxt is not null then regexp_replace(rtrim(l), ' {{2,}}', ' ', 'g') || '  ' else rtrim(regexp_replace(l, ' {{2,}}', ' ', 'g'), ' ' || chr(9)) end, chr(10) order by i)
    filter (not (l2 and l1 and l0)), chr(10) || ' ') || chr(10)) as digest from (
    select *, trim(l) = '' as l0, coalesce(lag(trim(l) = '') over w, false) as l1, true as l2, lead(i) over w as nxt from (
    select doc_id, unnest(range(len(ls))) as i, unnest(ls) as l from (select doc_id, string_split(replace({_ROUGH}, chr(13) || chr(10), chr(10)), chr(10)) as ls from documents))
    window w as (partition by doc_id order by i)) group by doc_id"""
)
def tidy_spaces(spark, sf_dir):
    return _digest(_docs(spark, sf_dir), "doc_id", T.tidy_spaces(_rough()))


@query(
    f"""select doc_id, len(ls) as n_lines, md5(array_to_string(ls, chr(10))) as digest from (select doc_id, [trim(regexp_replace(x, {_q(T.SPACE_CLASS + '+')}, ' ', 'g')) for x in
    regexp_split_to_array({_ROUGH}, '\\r\\n|[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x{{85}}\\x{{2028}}\\x{{2029}}]') if regexp_replace(x, {_q(T.SPACE_CLASS + '+')}, '', 'g') <> ''] as ls from documents)"""
)
def clean_lines(spark, sf_dir):
    lines = _docs(spark, sf_dir).select("doc_id", T.clean_lines(_rough()).alias("ls"))
    return lines.select("doc_id", F.size("ls").cast("long").alias("n_lines"), F.md5(F.array_join("ls", "\n").cast("binary")).alias("digest"))


@query(f"select doc_id, md5(regexp_replace({_ROUGH}, '(?m)^[ \\t]+', '', 'g')) as digest from documents")
def left_trimmed(spark, sf_dir):
    return _digest(_docs(spark, sf_dir), "doc_id", T.left_trim_lines(_rough()))


@query(
    f"""with l as (select doc_id, line_no::int as line_no, rtrim(trim(line), '.') as s from {_lines_sql('documents')}),
    c as (select *, len(regexp_extract_all(s, '\\p{{Lu}}')) as u, len(regexp_extract_all(s, '\\p{{L}}')) as a from l)
    select doc_id, line_no, u / a as share from c where a >= 3 and length(s) <= 55 and u / a >= 0.8"""
)
def caps_headings(spark, sf_dir):
    from .operators.lines import explode_lines

    rows = explode_lines(_docs(spark, sf_dir), "doc_id").where(T.caps_heading(F.col("line")))
    return rows.select("doc_id", "line_no", T.upper_share(F.rtrim(F.trim("line"), F.lit("."))).alias("share"))


@query(
    f"""select doc_id, len(regexp_extract_all(lower(text), '[{T.FOREIGN}]')) / nullif(len(regexp_extract_all(lower(text), '\\p{{L}}')), 0) as share, len(regexp_extract_all(text, '[\\p{{L}}\\p{{M}}]')) as n_letters,
    len(regexp_extract_all(text, '\\p{{Cf}}')) as n_format from documents"""
)
def foreign_letters(spark, sf_dir):
    count = lambda p: F.regexp_count("text", F.lit(p)).cast("long")
    return _docs(spark, sf_dir).select("doc_id", T.foreign_share(F.col("text")).alias("share"), count(r"[\p{L}\p{M}]").alias("n_letters"), count(r"\p{Cf}").alias("n_format"))


_PAIRS = [("th", "þ"), ("^^", '"'), ("an", "n"), ("þe", "the")]


@query("select doc_id, md5(" + "replace(" * len(_PAIRS) + "text" + "".join(f", {_q(a)}, {_q(b)})" for a, b in _PAIRS) + ") as digest from documents")
def literal_map(spark, sf_dir):
    return _digest(_docs(spark, sf_dir), "doc_id", T.replace_all(F.col("text"), _PAIRS))


@query(
    """with c as (select doc_id, string_split('a1b 11 1 c12 x1 1y ' || replace(replace(text, 'ea', 'e1'), 'on ', '1n 1 ') || ' z1', '') as c from documents),
    d as (select doc_id, c, unnest(range(1, len(c) + 1)) as i from c),
    e as (select doc_id, i, c[i] as x, c[i] = '1' and (coalesce(regexp_matches(c[i - 1], '[\\p{L}\\p{M}]'), false) or coalesce(regexp_matches(c[i + 1], '[\\p{L}\\p{M}]'), false))
    and not coalesce(regexp_matches(c[i - 1], '\\p{Nd}'), false) and not coalesce(regexp_matches(c[i + 1], '\\p{Nd}'), false) as slip from d)
    select doc_id, md5(string_agg(case when slip then 'l' else x end, '' order by i)) as digest, count(*) filter (slip) as n from e group by doc_id"""
)
def digit_slips(spark, sf_dir):
    rough = F.concat(F.lit("a1b 11 1 c12 x1 1y "), F.replace(F.replace("text", F.lit("ea"), F.lit("e1")), F.lit("on "), F.lit("1n 1 ")), F.lit(" z1"))
    text, n = T.digit_slips(F.col("t"), "1", "l")
    return _docs(spark, sf_dir).select("doc_id", rough.alias("t")).select("doc_id", F.md5(text.cast("binary")).alias("digest"), n.alias("n"))


@query("select doc_id, len([x for x in regexp_split_to_array(regexp_replace(text, '\\[[^\\]]*\\]', ' X ', 'g'), '[\\s/:$]+') if x <> '']) as n from documents")
def syllable_counts(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.syllables(F.col("text"), r"\s/:$").cast("long").alias("n"))


ROMANS = ["Il", "l|l.", "XIV", "Ill", "volume"]


@query(
    f"""select doc_id, case when regexp_matches(r, '^[IVXLCDMl|]+\\.?$') then translate(r, 'l|', 'II') else r end as roman, translate(doc_id::varchar, '0123456789', '{T.DIGITS['bn']}') as native, doc_id as back,
    array_to_string(regexp_extract_all(lang || doc_id || ',3.' || length(text), '[0-9]+'), '.') as dotted, array_to_string([list_extract(range(1, 8), i) for i in [3, 6]], ',') as thirds
    from (select *, {_list(ROMANS)}[doc_id % 5 + 1] as r from documents)"""
)
def numbers(spark, sf_dir):
    roman = F.element_at(F.array(*map(F.lit, ROMANS)), (F.col("doc_id") % 5 + 1).cast("int"))
    number = F.col("doc_id").cast("string")
    thirds = T.chunks(F.array(*[F.lit(str(i)) for i in range(1, 8)]), 3)
    return _docs(spark, sf_dir).select(
        "doc_id", T.roman_number(roman).alias("roman"), T.to_native_digits(number, "bn").alias("native"),
        T.from_native_digits(T.to_native_digits(number, "bn"), "bn").cast("long").alias("back"),
        T.dotted_number(F.concat("lang", number, F.lit(",3."), F.length("text").cast("string"))).alias("dotted"),
        F.array_join(F.transform(F.slice(thirds, 1, 2), lambda x: F.element_at(x, -1)), ",").alias("thirds"),
    )


@query("select page_id, regexp_extract(url, '([^/]*)$', 1) as name, len(list_distinct(regexp_extract_all(html, '(?i)<a\\s[^>]*?href=\"([^\"]*)\"', 1))) as n_links from pages")
def page_links(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", T.page_name(F.col("url")).alias("name"), F.size(X.links(F.col("html"))).cast("long").alias("n_links"))


@query("select event_id, json_extract_string(props, '$.k') as k from events")
def json_path(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


_PARTED = "text || chr(10) || chr(10) || '## One' || chr(10) || 'first' || chr(10) || chr(10) || ' ' || chr(10) || '## Two' || chr(10) || text || chr(10) || '### In' || chr(10) || '## End'"
def _parted():
    return F.concat(F.col("text"), F.lit("\n\n## One\nfirst\n\n \n## Two\n"), F.col("text"), F.lit("\n### In\n## End"))


@query(
    f"""select doc_id, len([x for x in regexp_split_to_array({_PARTED}, '\\n\\s*\\n') if trim(x) <> '']) as n_paragraphs, 'first' as one,
    md5(regexp_replace(text || chr(10) || '### In', '^\\s+', '')) as two from documents"""
)
def document_sections(spark, sf_dir):
    two = X.choose_variant(F.col("t"), ["Three", "Two", "One"])
    return _docs(spark, sf_dir).select("doc_id", _parted().alias("t")).select(
        "doc_id", F.size(X.paragraphs(F.col("t"))).cast("long").alias("n_paragraphs"), X.section(F.col("t"), "One").alias("one"), F.md5(two.cast("binary")).alias("two")
    )


@query(
    f"""select doc_id, md5(case when n > 0 then substr(raw, 1, n) else '' end || regexp_replace(string_agg(case when trim(l) = '' then l when starts_with(trim(l), '#') then l
    when regexp_matches(l, '^\\s*[0-9]+\\.\\s*$') then '## ' || trim(l) else rtrim(l, ' ') || '  ' end, chr(10) order by i), '^\\n+|\\n+$', '', 'g') || chr(10)) as digest from (
    select doc_id, raw, n, unnest(range(len(ls))) as i, regexp_replace(unnest(ls), '[ \\t]{{2,}}[0-9]+[ \\t]*$', '') as l from (select doc_id, raw, n, string_split({_BODY} || chr(10) || '12.' || chr(10) || 'verse   105' || chr(10), chr(10)) as ls from {_HEAD_N}))
    group by doc_id, raw, n"""
)
def format_pass(spark, sf_dir):
    raw = F.concat("raw", F.lit("\n12.\nverse   105\n"))
    return _digest(_headed(spark, sf_dir), "doc_id", X.format_document(raw, pattern=r"[0-9]+\.", level=2, breaks=True, numbers=True))


@query(
    f"""select doc_id, count(*) filter (f and t = 2)::int as hard, count(*) filter (not f)::int as blank, count(*) filter (f and t > 0 and t <> 2)::int as bad
    from (select doc_id, trim(l) <> '' as f, length(l) - length(rtrim(l)) as t from (select doc_id, unnest(string_split(replace({_ROUGH}, chr(13), ''), chr(10))) as l from documents)) group by doc_id"""
)
def break_counters(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", X.break_counts(F.replace(_rough(), F.lit("\r"))).alias("b")).select("doc_id", "b.*")


@query(
    f"""select doc_id, string_agg(line, chr(10) order by line_no) as kept from (select doc_id, line_no, line from {_lines_sql("(select doc_id, '12' || chr(10) || lang || chr(10) || ' A 2 ' || chr(10) || 'Digitized by' || chr(10) || source || chr(10) || '12345' || chr(10) || doc_id as text from documents)")})
    where not regexp_matches(line, '^\\s*([0-9]{{1,4}}|[A-Z]\\s?[0-9]{{1,3}}|Digitized by)\\s*$') group by doc_id"""
)
def furniture(spark, sf_dir):
    page = F.concat_ws("\n", F.lit("12"), "lang", F.lit(" A 2 "), F.lit("Digitized by"), "source", F.lit("12345"), F.col("doc_id").cast("string"))
    return _docs(spark, sf_dir).select("doc_id", X.drop_furniture(page).alias("kept"))


@query(
    f"""with l as (select doc_id, line_no, trim(line) as p from {_lines_sql('documents')} where trim(line) <> ''),
    j as (select *, lag(p) over (partition by doc_id order by line_no) as b from l)
    select doc_id, md5(string_agg(case when b is null then p when not regexp_matches(b, '[.!?"''”’]\\s*$') and regexp_matches(p, '^\\p{{Ll}}') then ' ' || p else chr(10) || chr(10) || p end, '' order by line_no)) as digest from j group by doc_id"""
)
def merged_paragraphs(spark, sf_dir):
    parts = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return _digest(_docs(spark, sf_dir).select("doc_id", parts.alias("p")).where("size(p) > 0"), "doc_id", X.merge_broken(F.col("p")))


@query(
    f"""with l as (select doc_id, line_no, trim(line) as p from {_lines_sql('documents')} where trim(line) <> ''),
    c as (select *, len(regexp_extract_all(lower(p), '[{T.FOREIGN}]')) as f, len(regexp_extract_all(lower(p), '\\p{{L}}')) as a, len(regexp_extract_all(p, '\\p{{L}}')) as n from l)
    select doc_id, md5(coalesce(string_agg(p, chr(10) || chr(10) order by line_no) filter (starts_with(p, '#') or (a > 0 and f / a < case when n >= 20 then 0.3 else 0.06 end)), '')) as digest from c group by doc_id"""
)
def own_language(spark, sf_dir):
    blocks = F.replace("text", F.lit("\n"), F.lit("\n\n"))
    return _digest(_docs(spark, sf_dir).where(F.trim(F.replace("text", F.lit("\n"))) != ""), "doc_id", X.own_language(blocks, 0.3))


@query(
    """select conv_id, md5(string_agg(case when i = 1 then '' when b = 1 and p = 0 then repeat(chr(10), 3) when b = 0 and p in (0, 1) then chr(10) else chr(10) || chr(10) end || t, '' order by turn)) as digest
    from (select *, row_number() over w as i, lag(p) over w as b from (select conv_id, turn, turn % 3 as p, trim(text) as t from conversations where trim(text) <> '') window w as (partition by conv_id order by turn)) group by conv_id"""
)
def verse_couplets(spark, sf_dir):
    verses = F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: F.struct((x["turn"] % 3).alias("position"), x["text"].alias("text")))
    return _digest(_t(spark, sf_dir, "conversations").where(F.trim("text") != "").groupBy("conv_id").agg(verses.alias("v")), "conv_id", X.couplets(F.col("v")))


@query(
    """select doc_id, md5(text || '漢字 and 本 [x] ※' || lang) as digest from documents"""
)
def annotations(spark, sf_dir):
    html = F.concat(
        F.col("text"), F.lit("<ruby><rb>漢字</rb><rp>(</rp><rt>かんじ</rt><rp>)</rp></ruby> and <ruby>本<rt>ほん</rt></ruby> ［＃note］"),
        F.lit('<img class="gaiji" src="a" alt="[x]"/> ※［＃rare］'), F.col("lang"), F.lit('<img gaiji="gaiji" src="b">'),
    )
    return _digest(_docs(spark, sf_dir), "doc_id", X.strip_notes(X.strip_readings(html)))


_GIVEN = "'Title' || chr(10) || '*** START OF THIS FILE ***' || chr(10) || chr(10) || 'Produced by A' || chr(10) || 'and B' || chr(10) || chr(10) || text || chr(10) || '*** END OF THIS FILE ***' || chr(10) || 'licence'"


@query("select doc_id, md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) as digest from documents")
def boilerplate(spark, sf_dir):
    file = F.concat(F.lit("Title\n*** START OF THIS FILE ***\n\nProduced by A\nand B\n\n"), F.col("text"), F.lit("\n*** END OF THIS FILE ***\nlicence"))
    return _digest(_docs(spark, sf_dir), "doc_id", X.strip_boilerplate(file))


@query("select doc_id, md5(substr(text, strpos(text, lang[1]), case when strpos(substr(text, strpos(text, lang[1])), '.') > 0 then strpos(substr(text, strpos(text, lang[1])), '.') - 1 else length(text) end)) as digest from documents where contains(text, lang[1]) and lang = 'en'")
def between_markers(spark, sf_dir):
    return _digest(_docs(spark, sf_dir).where("contains(text, 'e') and lang = 'en'"), "doc_id", markup.slice_between(F.col("text"), "e", "."))


@query(
    """select doc_id, md5(chr(10) || chr(10) || '# ' || lang || chr(10) || chr(10) || chr(10) || chr(10) || chr(10) || chr(10) || translate(text, '<>{}', '') || chr(10) || chr(10)) as digest from documents
    where regexp_matches(translate(text, '<>{}', ''), '^\\S') and regexp_matches(translate(text, '<>{}', ''), '\\S$')"""
)
def unwrapped_blocks(spark, sf_dir):
    plain = F.translate("text", "<>{}", "")
    page = F.concat(F.lit("{{header|title=x|file.pdf}}__NOTOC__<center> </center><center class='c'> "), "lang", F.lit(" </center><div><div x='y'>"), plain, F.lit(" </div></div>"))
    wrapped = X.unwrap_divs(X.center_headings(X.strip_top_templates(page)))
    return _digest(_docs(spark, sf_dir).where(plain.rlike(r"^\S") & plain.rlike(r"\S\z")), "doc_id", wrapped)


@query("select doc_id, md5('wordone two' || chr(10) || text || ' wordone') as digest from documents where not regexp_matches(text, '[0-9]')")
def joined_words(spark, sf_dir):
    rows = _docs(spark, sf_dir).where(~F.col("text").rlike("[0-9]"))
    mark = F.replace(F.col("text"), F.lit("\n"), F.lit("\x01"))
    out = X.join_attested("A-Za-z")(F.concat(F.lit("word\none two\x01"), mark, F.lit(" wordone")))
    return _digest(rows, "doc_id", F.replace(out, F.lit("\x01"), F.lit("\n")))


_TABLE = "'## Coverage matrix' || chr(10) || chr(10) || '| Family | Script | Locales | Books |' || chr(10) || '|---|---|---|---|' || chr(10) || '| Germanic, West | Latin | en, de | ' || length(text) || ' |' || chr(10) || '| Romance | Latin | ' || lang || ' | 7 |' || chr(10) || chr(10) || '| X | Y | z | 1 |'"


@query("select doc_id, unnest(['Germanic, West', 'Romance']) as family, unnest(['en,de', lang]) as locales, unnest([length(text), 7])::bigint as n from documents")
def coverage_tables(spark, sf_dir):
    table = F.concat(
        F.col("text"), F.lit("\n## Coverage matrix\n\n| Family | Script | Locales | Books |\n|---|---|---|---|\n| Germanic, West | Latin | en, de | "), F.length("text").cast("string"),
        F.lit(" |\n| Romance | Latin | "), F.col("lang"), F.lit(" | 7 |\n\n| X | Y | z | 1 |"),
    )
    rows = publish.coverage_rows(_docs(spark, sf_dir).select("doc_id", table.alias("text")))
    return rows.select("doc_id", "family", F.array_join("locales", ",").alias("locales"), "n")


@query(
    """with d as (select count(*) as books, count(distinct lang) as locales, count(distinct split_part(lang, '-', 1)) as languages, count(distinct lang) filter (lang not in ('ang', 'enm') and not starts_with(lang, 'en')) as beyond from documents)
    select * from (select doc_id, unnest(['languages', 'books', 'beyond_english']) as quantity, unnest([doc_id, doc_id % 5, 3]) as stated, unnest([languages, books, beyond]) as n from documents, d) where stated <> n"""
)
def stated_counts(spark, sf_dir):
    number = F.col("doc_id").cast("string")
    text = F.concat("text", F.lit("\n"), number, F.lit(" languages, "), (F.col("doc_id") % 5).cast("string"), F.lit("\n markdown\n files, 3 beyond modern\nEnglish"))
    docs = _docs(spark, sf_dir)
    derived = publish.derived_counts(docs.select(F.col("lang").alias("locale")))
    return publish.stated_counts(docs.select("doc_id", text.alias("text")), derived)


@query(
    """with a as (select 'books/' || lang || '/' || doc_id as path, case when doc_id % 50 < 25 then lang else 'xx' end as locale, case when doc_id % 7 = 1 then text || '.' else text end || doc_id as text from documents where doc_id % 10 <> 3),
    b as (select case when doc_id % 10 = 5 then 'moved/' else 'books/' end || lang || '/' || doc_id as path, lang as locale, text || doc_id as text from documents where doc_id % 11 <> 5),
    j as (select coalesce(a.path, b.path) as path, a.locale as la, b.locale as lb, a.text as ta, b.text as tb from a full join b using (path)),
    m as (select tb as t from j where la is null intersect select ta from j where lb is null),
    s as (select 'added' as section, lb as locale from j where la is null and tb not in (select t from m) union all select 'moved', lb from j where la is null and tb in (select t from m)
    union all select 'removed', la from j where lb is null and ta not in (select t from m) union all select 'revised', lb from j where ta <> tb
    union all select 'added locale', locale from (select locale from b except select locale from a) union all select 'lost locale', locale from (select locale from a except select locale from b))
    select section, locale, count(*) as n from s group by all"""
)
def changelog(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    number = F.col("doc_id").cast("string")
    text = F.concat(F.when(F.col("doc_id") % 7 == 1, F.concat("text", F.lit("."))).otherwise(F.col("text")), number)
    path = lambda top: F.concat(top, "lang", F.lit("/"), number).alias("path")
    locale = F.when(F.col("doc_id") % 50 < 25, F.col("lang")).otherwise("xx").alias("locale")
    old = docs.where("doc_id % 10 <> 3").select(path(F.lit("books/")), locale, text.alias("text"))
    top = F.when(F.col("doc_id") % 10 == 5, "moved/").otherwise("books/")
    new = docs.where("doc_id % 11 <> 5").select(path(top), F.col("lang").alias("locale"), F.concat("text", number).alias("text"))
    return publish.changelog(old, new)


@query(
    """select doc_id, '{"path": "books/' || doc_id || '.md", "locale": "' || lang || '", "title": "A \\"B\\"", "year": "c. 399 BCE", "zone": "x", "yearNumeric": -399, "sizeBytes": ' || strlen(text) || ', "wordCount": '
    || len([x for x in regexp_split_to_array(text, '""" + T.SPACE_CLASS + """+') if x <> '']) || '}' as record from documents"""
)
def index_record(spark, sf_dir):
    header = F.create_map(*map(F.lit, ["zone", "x", "year", "c. 399 BCE", "title", 'A "B"']))
    path = F.concat(F.lit("books/"), F.col("doc_id").cast("string"), F.lit(".md"))
    return _docs(spark, sf_dir).select("doc_id", publish.record_json(path, F.col("lang"), header, F.octet_length("text"), F.col("text")).alias("record"))


@query("select doc_id::varchar as path from documents where doc_id % 6 = 1 or doc_id % 10 = 0")
def stale_records(spark, sf_dir):
    docs = _docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("path"), "doc_id", F.col("text").alias("record"))
    old = docs.where("doc_id % 10 <> 0").withColumn("record", F.when(F.col("doc_id") % 6 == 1, F.concat("record", F.lit("x"))).otherwise(F.col("record")))
    return publish.stale(old, docs)


@query(
    """select lang as engine, n from (select lang, sum(length(regexp_replace(regexp_replace(text, '\\s', '', 'g'), '[0-9a-zA-Z]', '', 'g'))) / sum(length(regexp_replace(text, '\\s', '', 'g'))) as n from documents group by lang) order by n, lang desc limit 1""".replace("n from (", "n as noise from (")
)
def base_engine(spark, sf_dir):
    pages = _docs(spark, sf_dir).select(F.col("lang").alias("engine"), F.lit(1).alias("page_id"), "text")
    return relations.pick_base(pages, "a-zA-Z")


@query(
    """with a as (select doc_id as line_no, len([x for x in regexp_split_to_array(text, '[\\s]+') if x <> '']) as n_a from documents where doc_id % 9 <> 2),
    b as (select doc_id as line_no, len([x for x in regexp_split_to_array(case when doc_id % 4 = 1 then text || ' x' else text end, '[\\s]+') if x <> '']) as n_b from documents)
    select line_no, n_a::int as n_a, n_b::int as n_b from a full join b using (line_no) where n_a is distinct from n_b"""
)
def witness_counts(spark, sf_dir):
    docs = _docs(spark, sf_dir).select(F.col("doc_id").alias("line_no"), "text")
    other = docs.withColumn("text", F.when(F.col("line_no") % 4 == 1, F.concat("text", F.lit(" x"))).otherwise(F.col("text")))
    count = lambda t: T.syllables(t, r"\s")
    return relations.witness_lines(docs.where("line_no % 9 <> 2"), other, count, count)


@query("select lang, doc_id, n_chars from (select *, row_number() over (partition by lang order by n_chars desc, doc_id) as r from documents) where r <= 5")
def longest_by_lang(spark, sf_dir):
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n_chars"), "doc_id"))
    return _docs(spark, sf_dir).select("lang", "doc_id", "n_chars").withColumn("r", rank).where("r <= 5").drop("r")


@query("select source, lang from (select source, lang from documents where n_chars % 2 = 0 intersect select source, lang from documents where n_chars % 2 = 1) union all select source, 'none' from (select source from documents except select source from documents where lang = 'fr')")
def shared_sources(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("n_chars", "source", "lang")
    even, odd = (docs.where(F.col("n_chars") % 2 == k).select("source", "lang") for k in (0, 1))
    none = docs.select("source").subtract(docs.where("lang = 'fr'").select("source"))
    return even.intersect(odd).union(none.select("source", F.lit("none")))


@query("select doc_id, case when n_chars < 200 then 'short' when contains(text, '|') then 'table' when source is null then 'source' end as reason from documents")
def exclusion_reasons(spark, sf_dir):
    reason = F.when(F.col("n_chars") < 200, "short").when(F.contains("text", F.lit("|")), "table").when(F.col("source").isNull(), "source")
    return _docs(spark, sf_dir).select("doc_id", reason.alias("reason"))


@query(
    """with w as (select text, min(doc_id) as first_id, count(*) as n from documents group by text) select d.doc_id, d.lang, w.n from documents d join w on w.first_id = d.doc_id"""
)
def keep_first(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    first = docs.groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")).drop("h")
    return docs.select("doc_id", "lang").join(first, "doc_id")


@query("select a.doc_id, a.lang as lang_a, b.lang as lang_b from documents a join documents b on b.doc_id = a.doc_id + 1")
def next_document(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", "lang")
    return docs.select("doc_id", F.col("lang").alias("lang_a")).join(docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("lang").alias("lang_b")), "doc_id")


@query(
    """select doc_id, case when doc_id % 2 = 0 then 'Head Two' end as head, md5(text || chr(10) || chr(10) || '**sub**' || chr(10) || chr(10) || 'end') as digest,
    '|  |  |  |' || chr(10) || '|---|---|---|' || chr(10) || '| ' || lang || ' | ' || source || ' | x |' || chr(10) || '| y |  |  |' as names from documents where not contains(text, '*') and not regexp_matches(text, '^\\s')"""
)
def printed_heads(spark, sf_dir):
    label = F.lit("\n Label \n\nTitle\n")
    bold = F.when(F.col("doc_id") % 2 == 0, "**Head**\n\n**Two.**\n").otherwise("")
    page = F.concat(label, bold, F.col("text"), F.lit("\n **sub** \nend"))
    head, rest = X.printed_head(X.drop_labels(page, ["Title", "Label"], repeat=True), 2)
    docs = _docs(spark, sf_dir).where(~F.col("text").contains("*") & ~F.col("text").rlike(r"^\s"))
    return docs.select("doc_id", head.alias("head"), F.md5(X.isolate_bold(rest).cast("binary")).alias("digest"), X.list_table(F.array("lang", "source", F.lit("x"), F.lit("y"))).alias("names"))


@query("select doc_id, md5('pre' || chr(10) || chr(10) || '## II.' || chr(10) || chr(10) || text || chr(10) || chr(10) || '### 3.' || chr(10) || chr(10) || 'end') as digest from documents where regexp_matches(text, '^\\S') and regexp_matches(text, '\\S$')")
def outlines(spark, sf_dir):
    page = F.concat(F.lit("pre ARTICLE II. "), F.col("text"), F.lit(" SECTION 3. end"))
    marks = [(r"ARTICLE ([IVX]+)\.", "## "), (r"SECTION ([0-9]+)\.", "### ")]
    return _digest(_docs(spark, sf_dir).where(F.col("text").rlike(r"^\S") & F.col("text").rlike(r"\S\z")), "doc_id", X.outline(page, marks))


@query("select doc_id, md5('T' || chr(10) || chr(10) || lang || ' ' || source || chr(10) || chr(10) || translate(text, '|{}', '')) as digest from documents")
def table_verses(spark, sf_dir):
    page = F.concat(F.lit("{| class='x'\n|+ T\n! head\n|-\n|align=\"right\"| "), "lang", F.lit(" || "), "source", F.lit("\n|}\n"), F.translate("text", "|{}", ""))
    return _digest(_docs(spark, sf_dir), "doc_id", X.wiki_tables(page))


@query("select doc_id, md5(array_to_string([trim(x) for x in string_split(translate(text, '=<>{}[]|', ''), chr(10)) if trim(x) <> ''], chr(10))) as digest from documents")
def chosen_readings(spark, sf_dir):
    plain = F.translate("text", "=<>{}[]|", "")
    page = F.concat(F.lit("{{header}}<onlyinclude>===one===\n<poem>no</poem>\n===mine===<poem>\n"), plain, F.lit("<ref>x</ref>\n</poem>\n===two===</onlyinclude>"))
    return _digest(_docs(spark, sf_dir), "doc_id", X.choose_reading("mine")(page))
