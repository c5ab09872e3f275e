"""Whole flows as one plan each, with user-supplied model callables. What a model answers is written once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions import text as tx
from ticketloom.functions.columns import with_ordinal
from ticketloom.operators import filters, generation, joins, pages, replies, reports, similarity, windows
from ticketloom.session import release, written

Model = Callable[[list[str]], list[str]]


def _summaries(tickets: DataFrame, model: Model, prefix: str) -> DataFrame:
    """Assembled tickets(ticket_id, subject, issue_date, category, url, body, kommentare, Attachments) through
    prompts, the model and the parser to summaries, written."""
    tickets = written(tickets, "tickets")  # read twice; what made them went through Python
    prompts = written(replies.build_prompts(tickets), "prompts")
    answers = replies.score_prompts(prompts, model)
    routed = replies.route_replies(answers)
    known = tickets.select("ticket_id", "subject", "issue_date", "url").join(prompts.select("ticket_id", "urls", "filenames"), "ticket_id")
    summaries = written(replies.build_summaries(routed.filter("route = 'summary'"), known, prefix), "summaries")
    release(tickets, prompts, answers)  # whole texts, which nothing reads any more
    return summaries


def _blocks(summaries: DataFrame, batch_size: int) -> DataFrame:
    """Document blocks with the file that each belongs to."""
    content = F.concat_ws("\n\n", F.concat(F.lit("Problem\n"), F.col("problem")), F.concat(F.lit("Solution\n"), F.col("solution")))
    batches = windows.assign_batches(summaries.select("ticket_id", "subject"), batch_size, ["ticket_id"]).select("ticket_id", "file_name")
    blocks = tx.text_to_blocks(summaries.select("ticket_id", content.alias("content")), "ticket_id", "content")
    return blocks.join(batches, "ticket_id").withColumnRenamed("file_name", "doc_file")


def helpdesk_flow(
    landed: DataFrame, details: DataFrame, comments: DataFrame, attachments: DataFrame, closed: str, allowed: list[str], model: Model, page_size: int = 300, mode: str = "all", n: int | None = None, start_id: int | None = None, batch_size: int = 50
) -> tuple[DataFrame, DataFrame]:
    """Landed list pages(source, page_no, is_last, items) and details(key, ticket_id, …) -> (document blocks,
    rejected rows with reasons). Pages end where paging ended, ids come from the details, the scope is cut,
    rows are routed, tickets assembled with API attachments before those of the body, summarised, printed."""
    listed = joins.union_landed_pages(landed, page_size).select("key").distinct()
    ids = joins.resolve_ids(listed, details.select("key", "ticket_id"), "key", "ticket_id").select("ticket_id")
    number = F.col("ticket_id").cast("long")
    scope = filters.select_scope(ids.withColumn("_n", number), mode, n, start_id, id_col="_n").select("ticket_id")
    kept, rejected = filters.route_rejections(details.join(scope, "ticket_id", "left_semi"), closed, allowed)
    linked = tx.extract_links(kept, "ticket_id", "body", "https://files.example.com")
    of_body = linked.select(F.lit("ticket").alias("owner_kind"), F.col("ticket_id").alias("owner_id"), F.col("ord").cast("int").alias("a_ord"), "FileName", "Url", "Size")
    own = attachments.filter("owner_kind = 'ticket'").select(of_body.columns)
    merged = joins.merge_attachments(own, of_body).unionByName(attachments.filter("owner_kind = 'comment'").select(of_body.columns))
    clean = lambda df: df.withColumn("body", tx.clean_html(F.col("body")))
    whole = joins.assemble_tickets(clean(kept), clean(comments), merged)
    return _blocks(_summaries(whole, model, "HD-"), batch_size), rejected


def article_flow(overview: DataFrame, by_category: DataFrame, detail: DataFrame, base: str) -> DataFrame:
    """Articles of the overview and of each category, first wins, with detail values before those of the
    list; bodies become Markdown, then text, then blocks, one document for each category."""
    listed = joins.union_first_wins(overview, by_category, "ArticleId", "ord")
    merged = joins.merge_article_fields(detail, listed, "ArticleId", ["Subject", "Body", "CategoryName"], ["Tags"])
    text = tx.markdown_to_text(tx.bbcode_to_markdown(F.col("Body"), base))
    blocks = tx.text_to_blocks(merged.select("ArticleId", text.alias("content")), "ArticleId", "content")
    return blocks.join(merged.select("ArticleId", "Subject", windows.safe_subject(F.col("CategoryName")).alias("doc_file")), "ArticleId")


def tracker_flow(
    landed: DataFrame, issues: DataFrame, comments: DataFrame, existing: DataFrame, model: Model, base: str, page_size: int = 100, after: str | None = None, before: str | None = None, t_low: float = 0.78, t_merge: float = 0.84, batch_size: int = 50
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Landed issue pages and issues -> (clusters, canonical tickets in order, review pairs, document blocks).
    Issues resolved in the range become tickets, those that existing lacks are summarised, embedded, joined by
    similarity and clustered; the canonical ones are printed."""
    from ticketloom.operators.mapping import issues_to_tickets

    listed = joins.union_landed_pages(landed, page_size).select("key").distinct()
    resolved = filters.filter_resolved(issues.join(listed, "key", "left_semi"), True, after, before)
    tickets = issues_to_tickets(resolved, comments, base)
    known = existing.select(F.col("ticket_id").cast("string").alias("ticket_id")).distinct()
    new = tickets.join(known, "ticket_id", "left_anti")
    named = {"subject": "Subject", "issue_date": "IssueDate", "category": "CategoryName", "url": "Url", "body": "Body"}
    summaries = _summaries(new.withColumnsRenamed({v: k for k, v in named.items()}), model, "HD-")
    placed = written(with_ordinal(summaries, ["ticket_id"], "ord"), "placed")
    texts = placed.select("ord", tx.similarity_text(F.col("subject"), F.col("problem"), F.col("solution")).alias("text"))
    vectors = written(similarity.embed_texts(texts), "vectors")
    links = written(similarity.similarity_links(vectors, t_merge, t_merge), "links")
    clusters, canonical = similarity.cluster_duplicates(placed, links)
    canonical = written(canonical, "canonical")
    release(links)
    review = similarity.review_pairs(similarity.similarity_links(vectors, t_low, t_merge, at_once=True), placed)  # computed where it is read
    return clusters, windows.canonical_order(canonical), review, _blocks(canonical, batch_size)


def crm_flow(landed: DataFrame, manifest: DataFrame, extensions: list[str], folders: list[str], page_size: int = 100) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Landed pages of documents(ord, doc_id, extension, folder, name as JSON payload) -> (documents to load with
    collision-free names, counts, folders, samples of the largest folders)."""
    payload = "struct<doc_id:bigint,extension:string,folder:string,name:string>"
    items = joins.union_landed_pages(landed, page_size)
    docs = items.select(F.col("key").cast("long").alias("ord"), F.from_json("payload", payload).alias("d")).select("ord", "d.*")
    marked = filters.filter_documents(docs, extensions, folders)
    named = marked.withColumn("ext", filters.normal_extension(F.col("extension")))
    named = written(named.withColumn("stem", windows.safe_file_name(F.col("name"), F.col("doc_id"), F.col("ext"))).withColumn("dir", F.col("folder")), "crm-documents")
    todo = joins.drop_existing_files(named.filter("kept"), manifest)
    loaded = written(windows.number_collisions(todo.withColumn("file", F.concat("stem", "ext")), "file", "ord", folder="dir"), "crm-names")
    there = named.join(loaded.select("ord", F.lit(False).alias("exists_already")), "ord", "left").select("kept", F.coalesce("exists_already", F.lit(True)).alias("exists_already"), F.lit(False).alias("failed"))
    return loaded, reports.download_report(there), reports.folder_report(docs, "folder", "ord"), windows.group_samples(docs, "folder", 10, 3, "ord")


def qa_flow(paragraphs: DataFrame, qa_fn, per_chapter: int = 30, per_document: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Paragraphs -> (questions, totals by chapter and document, document blocks)."""
    chapters = written(pages.split_chapters(paragraphs).select(F.col("doc").cast("string").alias("source_file"), F.col("index").alias("chapter"), "title", "content", "token_estimate"), "chapters")
    return _questions(generation.generate_qa(chapters, qa_fn, per_chapter, per_document))


def covering_qa_flow(paragraphs: DataFrame, concept_fn, qa_fn, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same with questions asked until the concepts of a chapter are covered."""
    chapters = written(pages.split_chapters(paragraphs).select(F.col("doc").cast("string").alias("source_file"), F.col("index").alias("chapter"), "content"), "chapters")
    return _questions(generation.generate_until_covered(chapters, concept_fn, qa_fn, **options))


def _questions(items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    content = F.concat(F.lit("**"), F.col("question"), F.lit("**\n\n"), F.col("answer"))
    keyed = items.select("source_file", F.struct("source_file", "chapter", "question").alias("item"), content.alias("content"))
    blocks = tx.text_to_blocks(keyed, "item", "content").select("item.*", "block_ord", "style", "content", "runs").withColumn("doc_file", F.col("source_file"))
    return items, reports.qa_totals(items), blocks


def web_flow(landed: DataFrame, start: DataFrame, base: str, max_depth: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages(page_id, url, html) reachable from start(page) over the links that they hold -> (elements with the
    document of their depth, titles, catalogue of operations)."""
    links = pages.page_link_graph(landed)
    reached = written(pages.reachable_pages(links, start, max_depth), "reached")
    chosen = landed.join(reached.select(F.col("page").alias("page_id"), "depth"), "page_id")
    elements = pages.page_elements(chosen)
    placed = elements.join(reached.select(F.col("page").alias("page_id"), F.concat(F.lit("depth_"), F.col("depth").cast("string")).alias("doc_file")), "page_id")
    return placed, pages.page_titles(chosen), pages.operation_catalog(chosen, base)
