"""The registered queries over a catalog of tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.vocabulary import TYPE_WORDS
from ..operators import analysis as N
from ..operators import assets as A
from ..operators import bridge as B
from ..operators import discovery as D
from ..operators import graph as G
from ..operators import profile as P
from ..operators import retrieval as R
from ..operators.settings import Settings
from ..sources import files
from .catalog import Catalog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
EDGE = ("from_table", "from_column", "to_table", "to_column", "relation_type", "confidence", "discovery_method")

#: Columns of text whose words the lookups of names take.
TEXTS = (("documents", "text"), ("conversations", "text"), ("pages", "html"), ("part", "p_name"))
#: Feedback that relations are queried with.
FEEDBACK = (("customer.c_nationkey->nation.n_nationkey", "confirmed"), ("region.r_regionkey->nation.n_regionkey", "rejected"))
CN_ENDING = "编号"


def query(f: Callable[[Catalog], DataFrame]) -> Callable[[Catalog], DataFrame]:
    QUERIES[f.__name__] = lambda spark, sf_dir: f(Catalog.of(spark, sf_dir))
    return f


@query
def column_stats(c):
    return P.statistics(c.cells).drop("ordinal")


@query
def column_samples(c):
    return P.samples(c.cells, 20).withColumn("rank", F.col("rank").cast("bigint"))


@query
def column_dtypes(c):
    return c.columns.select("table", "column", "dtype")


@query
def primary_keys(c):
    return c.tables.select("table", "primary_key")


@query
def fk_candidates(c):
    return c.columns.where("is_fk_candidate").select("table", "column")


@query
def enum_columns(c):
    return c.columns.where("is_enum").select("table", "column", "unique_count")


@query
def numeric_columns(c):
    return c.columns.where("is_numeric").select("table", "column")


@query
def table_profile(c):
    return c.tables.select("table", "row_count", "col_count", "primary_key", "domain")


@query
def content_hash(c):
    return reduce(DataFrame.union, (P.content_hash(df).select(F.lit(t).alias("table"), "content_hash") for t, df in c.sources.items()))


@query
def domain_labels(c):
    return c.tables.select("table", "domain")


@query
def domain_best_match(c):
    return P.best_domain(c.tables.select("table"), "table")


@query
def graph_stats(c):
    n = c.columns.agg(F.count_distinct("table").alias("n_tables"), F.count("*").alias("n_columns"))
    return n.crossJoin(c.relations.agg(F.count("*").alias("n_relations")))


def _words(c: Catalog) -> DataFrame:
    """The words of the texts, and those that are names of columns."""
    texts = (c.sources[t].select(F.lit(t).alias("source"), F.col(x).alias("text")) for t, x in TEXTS)
    return D.words(reduce(DataFrame.union, texts, c.columns.select(F.lit("columns"), "column").toDF("source", "text")))


@query
def header_rows(c):
    """Documents as sheets: a line is a row, its words are the cells; and conversations, where a turn is a row."""
    of = lambda kind, key: F.concat_ws(":", F.lit(kind), key).alias("source")
    cells = lambda text: F.split(text, " ").alias("cells")
    lines = c.sources["documents"].select("doc_id", F.posexplode(F.split("text", "\n", 6)).alias("row_index", "line"))
    turns = c.sources["conversations"].select(of("conversation", F.col("conv_id")), F.col("turn").cast("int").alias("row_index"), cells(F.col("text")))
    rows = lines.select(of("document", F.col("doc_id")), "row_index", cells(F.col("line"))).union(turns)
    return P.header_rows(rows, TYPE_WORDS).withColumn("header_rows", F.col("header_rows").cast("bigint"))


def _old_schema(c: Catalog) -> DataFrame:
    """The columns as they were before: one missing, one of another type, one more."""
    old = c.columns.select("table", "column", "dtype").where("column <> 'p_size'")
    old = old.withColumn("dtype", F.when(F.col("column") == "o_totalprice", "str").otherwise(F.col("dtype")))
    return old.union(c.spark.createDataFrame([("nation", "n_comment", "str")], "table string, column string, dtype string"))


@query
def schema_diff(c):
    return P.schema_diff(_old_schema(c), c.columns.select("table", "column", "dtype"))


@query
def changelog(c):
    from ..streaming.incremental import changelog as entries

    return entries(_old_schema(c), c.columns.select("table", "column", "dtype"))


@query
def normalized_values(c):
    return c.norm.groupBy("table", "column").agg(F.count("*").alias("n_values"), F.min("value").alias("first_value"), F.max("value").alias("last_value"))


@query
def compound_values(c):
    """The lists that the orders of a customer make: over 256 characters long for many, which are taken apart before they are cut."""
    listed = c.sources["orders"].groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_list("o_orderkey")), "|").alias("order_ids"))
    listed = listed.withColumn("order_ids", F.when(F.col("o_custkey") % 3 == 0, F.concat("order_ids", F.lit("||"))).otherwise(F.translate("order_ids", "|", ";")))
    taken = D.normalised(P.cells({"buyer": listed})).where("column = 'order_ids'")
    return taken.select("value", F.length("value").cast("bigint").alias("n_chars"))


@query
def expand_column_names(c):
    extra = c.spark.createDataFrame([("sid",), ("tid_id",), ("mid",)], "column string")
    return D.expanded_names(c.columns.select("column").union(extra))


@query
def abbrev_lookup(c):
    return D.abbreviations_among(_words(c)).withColumn("place", F.col("place").cast("bigint"))


@query
def full_name_lookup(c):
    return D.full_names_among(_words(c))


@query
def clean_columns(c):
    return c.columns.select("table", "column", V.clean_name(F.col("column")).alias("clean"))


@query
def subsequence_match(c):
    return c.columns.select("column").distinct().join(c.tables.select("table"), V.is_subsequence(F.substring("column", 1, 4), F.col("table"))).select("column", "table")


@query
def excel_letters(c):
    """The last column that a document takes as a sheet with a row a line and a column a word."""
    width = F.array_max(F.transform(F.split("text", "\n"), lambda line: F.size(F.split(line, " "))))
    sheets = c.sources["documents"].select("doc_id", width.cast("bigint").alias("n_columns"))
    return sheets.select("doc_id", "n_columns", V.excel_letter(F.col("n_columns") - 1).alias("last_letter"))


@query
def candidate_columns(c):
    return c.candidates.select("table", "column", "dtype", "row_count", "unique_values", "is_id_like", "is_pk", F.col("priority").cast("bigint").alias("priority"))


@query
def value_inverted_index(c):
    return D.inverted_index(c.norm, c.candidates)


@query
def column_pair_overlap(c):
    return c.overlaps.select("table_a", "column_a", "table_b", "column_b", "shared", "gated")


@query
def incremental_pairs(c):
    return D.overlaps(c.norm, c.candidates, changed=("orders", "events")).select("table_a", "column_a", "table_b", "column_b", "shared")


@query
def containment_scores(c):
    return c.scores.select("table_a", "column_a", "table_b", "column_b", "direction", "match_type", V.cents(F.col("score")).alias("score"))


@query
def confidence_adjust(c):
    return D.adjusted(c.scores).select("table_a", "column_a", "table_b", "column_b", "confidence")


@query
def containment_relations(c):
    return c.containment.select(*EDGE)


@query
def relation_evidence(c):
    return D.shared_values(c.relations, c.norm)


@query
def naming_relations(c):
    return c.naming.select(*EDGE)


@query
def abbrev_mining(c):
    return D.mined_abbreviations(c.containment.unionByName(c.naming), c.tables)


@query
def abbrev_relations(c):
    return D.abbreviated(c.columns, c.tables, c.norm, c.containment.unionByName(c.naming)).select(*EDGE)


@query
def cn_bridge(c):
    """Columns with Chinese names for the words in the texts, against tables named by the words."""
    words = _words(c).select("word").distinct()
    return B.bridged(B.chinese_names(words, CN_ENDING).select("column"), words.withColumnRenamed("word", "table"))


@query
def column_index_cn(c):
    return A.cn_segments(B.chinese_names(_words(c), CN_ENDING).select(F.col("source").alias("table"), "column"))


@query
def transitive_relations(c):
    return c.transitive.select(*EDGE, "evidence")


@query
def feedback_apply(c):
    return D.with_feedback(c.direct, c.spark.createDataFrame(list(FEEDBACK), "relation_key string, status string")).select(*EDGE)


@query
def fuse_relations(c):
    return D.fused(c.all_relations).select(*EDGE)


@query
def dedupe_relations(c):
    return D.deduplicated(D.fused(c.all_relations)).select(*EDGE)


@query
def final_relations(c):
    return c.relations.select(*EDGE)


@query
def strict_relations(c):
    """The relations under settings of a file: one of two tables, of a confidence of 0.7 and more, and chains of links of 0.8 and more."""
    strict = Catalog(c.spark, c.sources, settings=Settings(chained=0.8, final=0.7, per_pair=1))
    strict.direct = c.direct  # does not depend on these settings
    return strict.relations.select(*EDGE)


@query
def enhanced_relations(c):
    return D.enhanced(c.relations, c.all_relations).select(*EDGE)


@query
def orphans(c):
    return G.orphans(c.nodes, c.relations)


@query
def table_degree(c):
    return G.degrees(c.nodes, c.relations)


@query
def join_paths(c):
    return G.paths(c.relations, 2, 0.65).select("src", "dst", F.col("hops").cast("bigint").alias("hops"), "path")


@query
def find_join_path(c):
    return G.paths(c.relations, 3, 0.6, source="lineitem").select("src", "dst", F.col("hops").cast("bigint").alias("hops"), "path")


@query
def centrality(c):
    return G.centrality(c.nodes, c.relations)


@query
def critical_path(c):
    return G.critical_path(c.relations)


@query
def cycles(c):
    return G.cycles(c.relations).withColumn("n_tables", F.col("n_tables").cast("bigint"))


@query
def communities(c):
    return G.communities(c.nodes, c.relations)


@query
def schema_summary(c):
    return A.schema_summary(c.tables)


@query
def llm_chunks(c):
    return A.llm_chunks(c.tables, c.columns, c.relations)


@query
def column_index(c):
    return A.column_index(c.columns)


@query
def relation_graph(c):
    return A.relation_graph(c.relations)


@query
def table_profiles(c):
    return A.table_profiles(c.tables, c.columns, c.relations)


@query
def table_description(c):
    return A.table_description(c.tables)


@query
def value_index(c):
    return A.value_index(c.cells, c.columns)


@query
def domain_graph(c):
    return A.domain_graph(c.relations, c.tables)


@query
def enum_cross_ref(c):
    return A.enum_cross_ref(c.cells, c.columns)


@query
def cell_locator(c):
    return A.cell_locator(c.columns)


@query
def query_table(c):
    return R.query_table(c.tables, c.relations, "item")


@query
def query_columns(c):
    return R.query_columns(c.tables, c.columns, "e", 5).withColumnRenamed("columns", "first_columns")


@query
def table_relations(c):
    return R.table_relations(c.relations, "orders")


@query
def find_by_column(c):
    return R.find_by_column(c.columns, "nation key?")


@query
def vector_topk(c):
    probe = [1.0 if k % 2 else -0.5 for k in range(len(c.sources["embeddings"].first()["embedding"]))]
    return R.vector_topk(c.sources["embeddings"], "vec_id", "embedding", probe, 10)


@query
def vector_neighbours(c):
    return R.vector_neighbours(c.sources["embeddings"], "vec_id", "embedding", 10)


@query
def vector_recall(c):
    """As ``vector_neighbours``, by an inverted file: nearly all of the rows, from some of the lists."""
    return R.VectorIndex(c.sources["embeddings"], "vec_id", "embedding", 10).nearest()


@query
def recall_tables(c):
    return R.recall_tables(c.tables, c.columns, "item region").withColumn("route", F.col("route").cast("bigint"))


@query
def expand_tables(c):
    return R.expand_tables(c.tables.where("table in ('nation')"), c.relations).withColumn("hop", F.col("hop").cast("bigint"))


@query
def build_context(c):
    return R.build_context(c.tables.where("table in ('nation', 'region', 'customer')"), A.llm_chunks(c.tables, c.columns, c.relations), c.relations)


@query
def locate_cell(c):
    rows = A.row_locator(c.sources["nation"], "nation", "n_nationkey")
    return R.locate_cell(A.cell_locator(c.columns), rows, "nation", "7", "n_name")


@query
def table_detail(c):
    return R.table_detail(c.columns, P.samples(c.cells, 10), c.relations, "nation")


@query
def rank_tables(c):
    return R.rank_tables(c.tables, G.cut(G.centrality(c.nodes, c.relations)), G.communities(c.nodes, c.relations), ["nation"])


@query
def seed_tables(c):
    return R.seed_tables(c.tables, ["nation", "world", "line"])


@query
def chunk_diff(c):
    after = c.tables.select("table", F.concat_ws("|", "table", "row_count").alias("chunk"))
    before = after.where("table <> 'part'").withColumn("chunk", F.when(F.col("table") == "region", "old").otherwise(F.col("chunk")))
    return R.chunk_diff(before.union(c.spark.createDataFrame([("gone", "x")], "table string, chunk string")), after)


@query
def report_recall(c):
    return R.report_recall(c.tables, c.columns, c.relations, "nation")


@query
def report_paths(c):
    return G.paths(c.relations, 3, 0.0).where("src = 'customer' and hops <= 3").orderBy("hops", "path").limit(5).select("src", "dst", F.col("hops").cast("bigint").alias("hops"), "path")


@query
def report_path_search(c):
    return G.paths(c.relations, 3, 0.0, ends=("er", "n")).select("src", "dst", F.col("hops").cast("bigint").alias("hops"), "path").orderBy("hops", "src", "dst").limit(5)


@query
def report_dag(c):
    return G.acyclic(c.relations)


@query
def analysis(c):
    return c.analysis


@query
def analysis_summary(c):
    return N.summary(c.analysis)


@query
def report_nodes(c):
    return A.report_nodes(c.tables, G.degrees(c.nodes, c.relations))


@query
def report_edges(c):
    return A.report_edges(c.relations)


@query
def summary_text(c):
    return A.summary_text(c.tables, c.relations, c.analysis)


@query
def chunks_text(c):
    return A.chunks_text(c.tables, c.columns, c.relations)


@query
def library_refresh(c):
    """The relations of a folder of sheets after some of them changed, went and came: what one build of the last state gives.

    The sheets are written from the given tables: first nation without some rows, customer and region; then nation whole, supplier and
    a sheet of every other customer come, and region goes.
    """
    from ..sources.versions import Versions
    from .library import Library
    from .store import shared_folder

    folder = f"{shared_folder(c.spark)}/library-{uuid.uuid4().hex[:12]}"
    lib = Library(c.spark, f"{folder}/sheets", f"{folder}/store")
    put = lambda name, df: files.write_sheet(df, f"{folder}/sheets/{name}.csv")
    put("nation", c.sources["nation"].where("n_nationkey < 20"))
    put("customer", c.sources["customer"])
    put("region", c.sources["region"])
    lib.refresh()
    put("nation", c.sources["nation"])
    put("supplier", c.sources["supplier"])
    put("client", c.sources["customer"].where("c_custkey % 2 = 0"))
    Versions(c.spark, folder).remove(f"{folder}/sheets/region.csv")
    lib.refresh()
    return lib.catalog.relations.select(*EDGE)
