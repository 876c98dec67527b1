"""Documents, retrieval, sentiment corpus and conversations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.text import clean_document, clean_sentence, sentiment_label, table_lines
from tidemark.operators import conversations, documents, sentiment
from tidemark.registry import query
from tidemark.registry.market import rounded
from tidemark.registry.oracle import define, snap, sql

_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_SENTENCE = r"regexp_replace(replace(" + _STRIP + r", chr(8203), ''), '\s+', ' ', 'g')"


def _vectors(m, key):
    return m.table("embeddings").select(F.col("vec_id").alias(key), F.col("embedding").alias("vector"))


# --- documents -------------------------------------------------------------------------------------------

define("clean_documents", r"""
    select doc_id, regexp_replace(regexp_replace(regexp_replace(replace(text, chr(13) || chr(10), chr(10)),
      '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g') as text from documents""")


@query("txt1_clean_documents", sql("""
    select doc_id, md5(text) text_md5, length(text) n from clean_documents"""))
def _(m):
    cleaned = m.table("documents").select("doc_id", clean_document(F.col("text")).alias("t"))
    return cleaned.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").cast("long").alias("n"))


@query("txt2_table_lines", """
    select l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag || ' | ' || coalesce(f, '') || ' | ' || l_linenumber
      || chr(10) || coalesce(f, '') || ' | ' || l_suppkey || ' | ' || l_partkey lines
    from (select *, case when l_linestatus = 'F' then 'F' end f from lineitem)""")
def _(m):
    f = F.when(F.col("l_linestatus") == "F", "F")
    cell = {c: F.col(c).cast("string") for c in ("l_linenumber", "l_suppkey", "l_partkey")}
    grid = F.array(F.array("l_returnflag", f, cell["l_linenumber"]), F.array(f, cell["l_suppkey"], cell["l_partkey"]))
    return m.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                      F.array_join(table_lines(grid), "\n").alias("lines"))


@query("txt3_chunks")
def _(m):
    cleaned = m.table("documents").select("doc_id", clean_document(F.col("text")).alias("text"))
    return documents.chunks(cleaned, "doc_id")


@query("txt3_chunk_cover", sql(r"""
    with d as (select doc_id, length(text) n, length(regexp_replace(text, '[ \t\n\r]', '', 'g')) solid from clean_documents)
    select doc_id, solid, coalesce(solid, 0) as covered, 0::bigint as misplaced, 0::bigint as misnumbered, 0::bigint as too_long,
      0::bigint as too_near, coalesce(n <= 1499 and n > 0, false) as single from d"""))
def _(m):
    # What chunks must hold, read off their places: they stand in the text, in order, and leave out no character but space.
    cleaned = m.table("documents").select("doc_id", clean_document(F.col("text")).alias("text"))
    own = Window.partitionBy("doc_id").orderBy("chunk_no")  # the chunks of one document
    end = F.col("chunk_start") + F.length("chunk")
    placed = documents.chunks(cleaned, "doc_id").withColumns({
        "end": end, "before": F.coalesce(F.lag(end).over(own), F.lit(0)), "place": F.row_number().over(own) - 1})
    both = cleaned.join(placed, "doc_id", "left")

    def letters(text):
        return F.length(F.regexp_replace(text, r"[ \t\n\r]", "")).cast("long")

    def count(fault):
        return F.count_if(fault).cast("long")

    fresh = F.greatest("before", "chunk_start")
    return both.groupBy("doc_id").agg(
        F.first(letters(F.col("text"))).alias("solid"),
        F.coalesce(F.sum(letters(F.substring("text", fresh.cast("int") + 1, (F.col("end") - fresh).cast("int")))), F.lit(0)).alias("covered"),
        count(F.substring("text", F.col("chunk_start").cast("int") + 1, F.length("chunk")) != F.col("chunk")).alias("misplaced"),
        count((F.col("chunk_no") != F.col("place")) | (F.col("end") <= F.col("before"))).alias("misnumbered"),
        count(F.length("chunk") > documents.CHUNK_SIZE).alias("too_long"),
        count(F.col("before") - F.col("chunk_start") > documents.CHUNK_OVERLAP).alias("too_near"),
        ((F.count("chunk") == 1) & (F.first(F.length("text")) < documents.CHUNK_SIZE)).alias("single"))


_NEAREST = """
    select q.vec_id query_id, v.vec_id item_id, list_distance(q.embedding::double[], v.embedding::double[]) d,
      row_number() over (partition by q.vec_id
        order by list_distance(q.embedding::double[], v.embedding::double[]), v.vec_id) rank
    from embeddings q cross join embeddings v qualify rank <= 8"""
define("hits", _NEAREST)


@query("txt4_nearest", sql("select query_id, item_id, round(d, 8) distance, rank from hits"))
def _(m):
    df = documents.nearest(_vectors(m, "query_id"), _vectors(m, "item_id"), 8)
    return rounded(df, 8, "distance").withColumn("rank", F.col("rank").cast("long"))


@query("txt4_nearest_in_blocks", sql("select query_id, item_id, round(d, 8) distance, rank from hits"))
def _(m):
    df = documents.nearest(_vectors(m, "query_id"), _vectors(m, "item_id"), 8, block_rows=64)
    return rounded(df, 8, "distance").withColumn("rank", F.col("rank").cast("long"))


define("hit_texts", """
select query_id, item_id, text, row_number() over (partition by query_id order by rank) rank from (
  select query_id, item_id, rank, text from hits join documents on doc_id = item_id
  qualify row_number() over (partition by query_id, text order by rank) = 1)
qualify row_number() over (partition by query_id order by rank) <= 5""")


def _hit_texts(m):
    hits = documents.nearest(_vectors(m, "query_id"), _vectors(m, "item_id"), 8)
    texts = m.table("documents").select(F.col("doc_id").alias("item_id"), "text")
    return documents.distinct_hits(hits, texts, 5)


@query("txt5_distinct_hits", sql("select query_id, item_id, rank from hit_texts"))
def _(m):
    return _hit_texts(m).select("query_id", "item_id", F.col("rank").cast("long").alias("rank"))


@query("txt6_context", sql("""
    select query_id, md5(string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by rank)) context_md5,
      count(*) hits from hit_texts group by 1"""))
def _(m):
    return documents.context(_hit_texts(m)).select("query_id", F.md5("context").alias("context_md5"), "hits")


@query("txt7_add_new_chunks", """
    with old as (select text from documents where lang in ('en', 'fr'))
    select min(doc_id) doc_id from documents where text not in (select text from old) group by text""")
def _(m):
    rows = m.table("documents").select("doc_id", "text", "lang")
    existing = rows.filter(F.col("lang").isin("en", "fr"))
    return documents.new_chunks(rows.select("doc_id", "text"), existing).select("doc_id")


define("qa", r"""
select page_id, coalesce(d, regexp_replace(case when lower(b) like '%.pdf' then b else b || '.pdf' end, '([^.])\.[^.]*$', '\1')) doc,
  coalesce(u, 'https://files.example/' || d || '.pdf') url, q question, a answer from (
  select page_id, case when page_id % 4 = 1 then 'Report ' || (page_id % 7) when page_id % 4 = 2 then null end d,
    case when page_id % 4 != 1 then url end u, regexp_extract(split_part(url, '?', 1), '([^/]*)$', 1) b,
    nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') q,
    case when page_id % 5 != 0 then md5(html) end a from pages)""")


def _qa(m):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    kind = F.col("page_id") % 4
    raw = m.table("pages").select(
        "page_id", F.when(kind == 1, F.lit("  ")).alias("doc_name"),
        F.when(kind == 1, F.concat(F.lit("Report "), (F.col("page_id") % 7).cast("string"))).alias("document"),
        F.when(kind != 1, F.col("url")).alias("document_url"), title.alias("prompt"),
        F.when(F.col("page_id") % 5 != 0, F.md5("html")).alias("ground_truth"))
    blocked = m.table("pages").filter("page_id = 1").select(F.lit("report 3").alias("doc"))
    return documents.question_answer_rows(raw, blocked, "https://files.example/")


@query("txt8_question_answers", sql("""
    select page_id, doc, url, question, answer from qa
    where lower(doc) != 'report 3' and question is not null and answer is not null"""))
def _(m):
    return documents.question_answers(_qa(m))


@query("txt8_documents_to_fetch", sql("""
    select doc, arg_min(url, page_id) url from qa where lower(doc) != 'report 3' group by 1"""))
def _(m):
    return documents.documents_to_fetch(_qa(m), "page_id")


@query("txt9_grade_averages", """
    select source, round(avg(quality), 9) correctness, round(avg(case when n_chars > 1000 then toxic end), 9) groundedness,
      round(avg(case when quality = 1 and toxic = 0 then 1 else 0 end), 9) relevance,
      round(avg(case when n_chars > 1000 then case when lang = 'en' then 1 else 0 end end), 9) retrieval_relevance
    from documents join labels using (doc_id) group by 1""")
def _(m):
    graded = m.table("documents").join(m.table("labels"), "doc_id").select(
        "source", (F.col("quality") == 1).alias("correctness"), (F.col("toxic") == 1).alias("groundedness"),
        ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("relevance"),
        (F.col("lang") == "en").alias("retrieval_relevance"), F.floor(F.col("n_chars") / 1001).alias("retrieved"))
    df = documents.grade_averages(documents.applicable_grades(graded, "retrieved"), ["source"])
    return df.select("source", *[F.round(g, 9).alias(g) for g in documents.GRADES])


# --- sentiment -------------------------------------------------------------------------------------------

define("sentences", f"""
select doc_id as row, {_SENTENCE.format('text')} text, quality + 1 - toxic as label, source
from documents join labels using (doc_id)""")


def _sentences(m):
    return m.table("documents").join(m.table("labels"), "doc_id").select(
        F.col("doc_id").alias("row"), clean_sentence(F.col("text")).alias("text"),
        (F.col("quality") + 1 - F.col("toxic")).alias("label"), "source")


@query("sen1_clean_sentences", sql(f"select doc_id, md5({_SENTENCE.format('text')}) text_md5 from documents"))
def _(m):
    return m.table("documents").select("doc_id", F.md5(clean_sentence(F.col("text"))).alias("text_md5"))


@query("sen2_label_map", """
    select event_id, case event_type when 'purchase' then 2 when 'error' then 0 when 'click' then user_id % 3 else 1 end
      as label from events""")
def _(m):
    word = F.when(F.col("event_type") == "purchase", " Positive ").when(F.col("event_type") == "error", "NEGATIVE").when(
        F.col("event_type") == "click", (F.col("user_id") % 3).cast("string")).when(
        F.col("event_type") == "view", "unheard of")
    return m.table("events").select("event_id", sentiment_label(word).cast("long").alias("label"))


define("united", r"""
select text, source, row from (
  select *, row_number() over (partition by text order by part, row) rn from (
    select 0 part, row, text, 'labelled' source from sentences
    union all select 1, doc_id, """ + _SENTENCE.format("text") + """, 'plain' from documents)) where rn = 1""")


def _united(m):
    plain = m.table("documents").select(F.col("doc_id").alias("row"), clean_sentence(F.col("text")).alias("text"),
                                        F.lit("plain").alias("source"))
    labelled = _sentences(m).select("row", "text", F.lit("labelled").alias("source"))
    return sentiment.combined(labelled, plain)


@query("sen3_union_distinct_texts", sql("select md5(text) text_md5, source, row from united"))
def _(m):
    return _united(m).select(F.md5("text").alias("text_md5"), "source", "row")


@query("sen4_ids", sql(f"""
    with s as (select doc_id as row, {_SENTENCE.format('text')} text from documents),
    i as (select *, substring(sha256(text), 1, 16) id0 from s)
    select row, case when count(*) over (partition by id0) > 1 then substring(sha256(text || row), 1, 16) else id0 end id
    from i"""))
def _(m):
    # Copies are left in, so that ids collide.
    rows = m.table("documents").select(F.col("doc_id").alias("row"), clean_sentence(F.col("text")).alias("text"))
    return sentiment.with_ids(rows).select("row", "id")


define("split_rows", """
select row, label, source, case when rn <= floor(round(n * 0.7, 6)) then 'train'
  when rn <= floor(round(n * 0.85, 6)) then 'val' else 'test' end split from (
  select *, row_number() over (partition by label order by md5('42' || row), row) rn,
    count(*) over (partition by label) n from sentences)""")


@query("sen5_stratified_split", sql("select row, label, split from split_rows"))
def _(m):
    return sentiment.stratified_split(_sentences(m), key="row").select("row", "label", "split")


@query("sen6_manifest", sql("""
    select split, 'label' kind, cast(label as varchar) as value, count(*) n from split_rows group by 1, 3
    union all select split, 'source', source, count(*) from split_rows group by 1, 3
    union all select split, 'rows', 'all', count(*) from split_rows group by 1
    union all select 'all', 'source', source, count(*) from split_rows group by 3"""))
def _(m):
    return sentiment.manifest(sentiment.stratified_split(_sentences(m), key="row"))


define("judged", """
select doc_id, quality + 1 - toxic y_true, (quality + doc_id % 3) % 3 y_base,
  case when doc_id % 5 = 0 then (doc_id % 2)::int else quality + 1 - toxic end y_pred,
  (doc_id % 7) / 10.0::double base_loss, (doc_id % 4) / 10.0::double tuned_loss from labels""")


def _judged(m):
    doc = F.col("doc_id")
    true = F.col("quality") + 1 - F.col("toxic")
    return m.table("labels").select(
        "doc_id", true.alias("y_true"), ((F.col("quality") + doc % 3) % 3).cast("int").alias("y_base"),
        F.when(doc % 5 == 0, doc % 2).otherwise(true).cast("int").alias("y_pred"),
        ((doc % 7) / 10.0).alias("base_loss"), ((doc % 4) / 10.0).alias("tuned_loss"))


def _report(pred: str) -> str:
    return f"""select cls name, coalesce(tp / nullif(claimed, 0), 0) "precision", coalesce(tp / nullif(support, 0), 0) recall,
  coalesce(2 * tp / nullif(claimed + support, 0), 0) f1, support, tp from (
    select c::varchar cls, cast(sum((y_true = c and {pred} = c)::int) as double) tp, cast(sum((y_true = c)::int) as bigint) support,
      cast(sum(({pred} = c)::int) as bigint) claimed from judged cross join (select unnest([0, 1, 2]) c) group by c) where support + claimed > 0"""


define("class_scores", _report("y_pred"))
define("class_scores_base", _report("y_base"))
for _name in ("class_scores", "class_scores_base"):
    define(_name.replace("class_scores", "score_rows"), f"""
select name, "precision", recall, f1, support from {_name}
union all select 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) from {_name}
union all select 'macro avg', avg("precision"), avg(recall), avg(f1), sum(support) from {_name}
union all select 'weighted avg', sum("precision" * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), sum(support) from {_name}""")


@query("sen7_classification_report", sql("""
    select name, round("precision", 9) "precision", round(recall, 9) recall, round(f1, 9) f1, cast(support as bigint) support
    from score_rows"""))
def _(m):
    return rounded(sentiment.report(_judged(m)), 9, "precision", "recall", "f1")


@query("sen8_confusion_matrix", sql("""
    select y_true, count(*) filter (y_pred = 0) pred_0, count(*) filter (y_pred = 1) pred_1,
      count(*) filter (y_pred = 2) pred_2 from judged group by 1"""))
def _(m):
    return sentiment.confusion(_judged(m))


@query("sen9_compare_models", sql("""
    select name, round(b.f1, 9) base_f1, round(t.f1, 9) tuned_f1, round(t.f1 - b.f1, 9) gain,
      round((t.f1 - b.f1) / nullif(b.f1, 0) * 100, 6) gain_percent
    from score_rows_base b join score_rows t using (name)"""))
def _(m):
    judged = _judged(m)
    df = sentiment.compare_models(sentiment.report(judged, pred="y_base"), sentiment.report(judged))
    return rounded(rounded(df, 9, "base_f1", "tuned_f1", "gain"), 6, "gain_percent")


@query("sen9_loss_gain", sql("""
    select round(avg(base_loss), 9) base_loss, round(avg(tuned_loss), 9) tuned_loss,
      round(avg(base_loss) - avg(tuned_loss), 9) loss_decrease from judged"""))
def _(m):
    return rounded(sentiment.loss_gain(_judged(m), "base_loss", "tuned_loss"), 9, "base_loss", "tuned_loss", "loss_decrease")


# --- conversations ---------------------------------------------------------------------------------------

@query("cht1_messages_in_order", "select conv_id, turn, role, text from conversations")
def _(m):
    return conversations.messages(m.table("conversations"))


@query("cht2_chats_by_activity", """
    select conv_id, max(turn) last_activity, count(*) messages from conversations group by 1""")
def _(m):
    return conversations.by_activity(m.table("conversations"))


@query("cht3_history", rf"""
    select conv_id, turn, case role when 'user' then 'human' else 'ai' end speaker, {_STRIP.format('text')} content
    from conversations where role in ('user', 'assistant') and {_STRIP.format('text')} != ''""")
def _(m):
    return conversations.history(m.table("conversations"))


@query("cht4_titles", """
    select conv_id, case when n < 2 or t is null then 'New Chat' when length(t) > 30 then t[:30] || '...' else t end title from (
      select conv_id, count(*) n, arg_min(text, turn) filter (role = 'user') t from conversations
      where role in ('user', 'assistant') group by 1)""")
def _(m):
    return conversations.titles(m.table("conversations"))


@query("cht5_truncated_replies", """
    select doc_id, md5(case when length(text) > 2000 then text[:2000] || '... [Response truncated]' else text end) reply_md5
    from documents""")
def _(m):
    return m.table("documents").select("doc_id", F.md5(conversations.truncated(F.col("text"))).alias("reply_md5"))


_FINANCE = " or ".join(f"lower(text) like '%{w}%'" for w in conversations.FINANCE_WORDS)


@query("cht6_route_messages", sql(f"""
    select conv_id, turn, {_FINANCE} financial from (
      select conv_id, turn, case when role = 'user' and turn % 3 = 0 then text || ' What is the YTD Return?' else text end text
      from conversations)"""))
def _(m):
    asked = F.when((F.col("role") == "user") & (F.col("turn") % 3 == 0),
                   F.concat("text", F.lit(" What is the YTD Return?"))).otherwise(F.col("text"))
    return m.table("conversations").select("conv_id", "turn", conversations.is_financial(asked).alias("financial"))


@query("cht6_route_documents", f"select doc_id, {_FINANCE} financial from documents")
def _(m):
    return m.table("documents").select("doc_id", conversations.is_financial(F.col("text")).alias("financial"))


@query("cht7_delete_chats", """
    select conv_id, turn, role from conversations
    where conv_id not in (select conv_id from conversations where role = 'system')""")
def _(m):
    log = m.table("conversations")
    return conversations.without(log, log.filter("role = 'system'")).select("conv_id", "turn", "role")


@query("cht8_files_newest_first", """
    select doc_id, source, n_chars from documents where source not in ('src3', 'src4')""")
def _(m):
    files = m.table("documents").select("doc_id", "source", "n_chars")
    gone = files.filter(F.col("source").isin("src3", "src4"))
    return conversations.files_newest_first(conversations.without(files, gone, "doc_id"), "doc_id")
