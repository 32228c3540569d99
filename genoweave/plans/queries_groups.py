"""Registered queries: counts, lists per group, peptide strings and ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoweave.operators import clean, heavy, lists, ranks, user_aggregates
from genoweave.plans import flows
from genoweave.plans.oracle_parts import page
from genoweave.plans.queries_sites import codes
from genoweave.plans.registry import query
from genoweave.session import written

PROFILED = ["rsid", "gene_name", "chrom_start", "coordinate", "chrom", "frame", "alleles", "codons", "peptides"]
PROFILE_SQL = " union all ".join(
    f"select '{c}' as \"column\", cast({c} as varchar) as value, count(*) as count from sites where {c} is not null "
    f"group by {c}"
    for c in PROFILED
)
CALL_PROFILED = ["patient", "rsid", "l_orderkey", "l_linenumber", "gt", "gt_idx", "ref", "alt"]
CALL_PROFILE_SQL = " union all ".join(
    f"select '{c}' as \"column\", cast({c} as varchar) as value, count(*) as count from calls where {c} is not null "
    f"group by {c}"
    for c in CALL_PROFILED
)


@query("column_value_counts", "calls", CALL_PROFILE_SQL)
def _(x):
    return clean.by_frequency(clean.column_profile(x.calls))


@query("top_values", "sites",
       f"select * from ({PROFILE_SQL}) t order by count desc, \"column\", value limit 20")
def _(x):
    return clean.top_values(clean.column_profile(x.sites), 20)


@query("top_values_bounded", "sites",
       f"select * from ({PROFILE_SQL}) t order by count desc, \"column\", value limit 20")
def _(x):
    """The same from summaries of 64 values a column and task; columns they do not prove are counted in full."""
    found = heavy.top_values(written(x.sites), 20, entries=64).withColumnRenamed("n", "count")
    return clean.top_values(found.drop("rank"), 20)


@query("group_list_text", "calls sites",
       "select gene_name, pos//1000 as page, "
       "'['||string_agg(''''||rsid||'''', ', ' order by rsid)||']' as rsids_list from "
       "(select s.gene_name, c.rsid, row_number() over (partition by s.gene_name order by c.rsid)-1 as pos "
       "from calls c join sites s on c.rsid=s.rsid) t group by 1, 2")
def _(x):
    rows = x.calls.select("rsid").join(x.sites.select("rsid", "gene_name"), "rsid")
    return lists.group_lists(rows, ["gene_name"], "rsid", "rsids_list", page_items=1000)


def _concat_sql(column: str) -> str:
    return (
        f"select gene_name, '{column}' as name, pos//100 as page, string_agg(v,'' order by v) as text "
        f"from (select *, {page('gene_name', 'v', 1)} as pos from "
        f"(select distinct gene_name, cast({column} as varchar) as v from sites where {column} is not null) a) b "
        "group by gene_name, page"
    )


CONCAT = [c for c in PROFILED if c != "gene_name"]


@query("distinct_concat_all_columns", "sites",
       "select gene_name, page, "
       + ", ".join(f"max(case when name='{c}' then text end) as {c}" for c in CONCAT)
       + f" from ({' union all '.join(_concat_sql(c) for c in CONCAT)}) t group by gene_name, page")
def _(x):
    return lists.distinct_concat(x.sites, "gene_name", page_items=100)


@query("user_distinct_concat", "sites",
       "select gene_name, " + ", ".join(f"string_agg(distinct {c}, '' order by {c}) as {c}" for c in ("alleles", "codons", "peptides"))
       + " from sites group by gene_name")
def _(x):
    """Distinct values of every column, sorted and joined, by a caller's own functions over pages of 50 rows."""
    names = ["alleles", "codons", "peptides"]

    def distinct(table):
        import pyarrow as pa

        parts = [pa.table({"name": [n] * len(v), "value": v}, pa.schema([("name", pa.string()), ("value", pa.string())]))
                 for n in table.column_names for v in [table[n].combine_chunks().unique().drop_null()]]
        return pa.concat_tables(parts)

    def merge(table):
        return table.group_by(["name", "value"]).aggregate([]).select(["name", "value"])

    def finish(table):
        import pyarrow as pa

        rows = sorted(zip(*(table[c].to_pylist() for c in ("name", "value"))))
        return pa.table({n: ["".join(v for m, v in rows if m == n)] for n in names})

    rows = x.sites.select("gene_name", "rsid", *names)
    keyed = user_aggregates.aggregate_pages(
        rows, ["gene_name"], ["rsid"], lambda t: distinct(t.select(names)), merge, finish, "name string, value string",
        ", ".join(f"{n} string" for n in names), page_items=50, fan_in=2)
    return keyed


@query("rsids_by_gene_space", "header", "select gene_name, page, rsids from header")
def _(x):
    return flows.header_rsids(codes(x))


@query("rsids_by_gene_comma", "sites",
       f"select gene_name, page, string_agg(rsid,',' order by rsid) as rsids from "
       f"(select gene_name, rsid, {page('gene_name', 'rsid', 5)} as page from sites) t group by 1, 2")
def _(x):
    return lists.ids_by_gene(x.sites, ",", page_items=5)


@query("concat_self_ordered", "calls sites",
       "select gene_name, pos//200 as page, string_agg(gt,'' order by gt) as pepstr from "
       "(select s.gene_name, c.gt, row_number() over (partition by s.gene_name order by c.gt)-1 as pos "
       "from calls c join sites s on c.rsid=s.rsid) t group by 1, 2")
def _(x):
    rows = x.calls.select("rsid", "gt").join(x.sites.select("rsid", "gene_name"), "rsid")
    return lists.paged_runs(rows, ["gene_name"], "gt", "", "pepstr", page_items=200)


@query("global_concat", "decoded",
       "select pos//10000 as page, string_agg(peptide_group,'' order by peptide_group) as text from "
       "(select peptide_group, row_number() over (order by peptide_group)-1 as pos from decoded "
       "where peptide_group is not null) t group by 1")
def _(x):
    decoded = flows.decode_genotypes(x.calls, codes(x)).filter("peptide_group is not null")
    return lists.paged_runs(decoded, [], "peptide_group", "", "text")


@query("distinct_keys", "sites", "select gene_name as gene from sites group by gene_name")
def _(x):
    return x.sites.select(F.col("gene_name").alias("gene")).distinct()


@query("table_counts", "calls sites",
       "select 'calls' as name, count(*) as n from calls union all select 'sites', count(*) from sites")
def _(x):
    def count(name, df):
        return df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")

    return count("calls", x.calls).unionByName(count("sites", x.sites))


@query("gene_peptides", "gene_strings",
       "select patient, gene_name, page, rsids, peptide_string from gene_strings")
def _(x):
    return flows.gene_peptides(flows.decode_genotypes(x.calls, codes(x)))


@query("gene_peptides_audit", "decoded",
       "select patient, gene_name, page, string_agg(trail,',' order by rsid, trail, peptide_group) as trails, "
       "string_agg(peptide_group,'' order by rsid, trail, peptide_group) as peptide_string from "
       "(select distinct patient, gene_name, page, rsid, gt||'-'||alleles||'-'||peptides as trail, "
       "peptide_group from decoded) t group by patient, gene_name, page")
def _(x):
    return flows.gene_peptides_audit(x.calls, codes(x))


def pop_codes(x):
    return flows.site_codes(x.sites, ("chrom", "gene_name"))


def pop_strings(x):
    return flows.population_strings(x.calls, pop_codes(x))


@query("population_strings", "pop_strings", "select * from pop_strings")
def _(x):
    return pop_strings(x)


@query("gene_string_on_rows", "pairs pop_strings",
       "select p.patient, p.chrom, p.gene_name, p.page, p.rsid, p.l_orderkey, p.l_linenumber, s.pepstr "
       "from pairs p join pop_strings s on p.patient=s.patient and p.chrom=s.chrom "
       "and p.gene_name=s.gene_name and p.page=s.page")
def _(x):
    keys = ["patient", "chrom", "gene_name", "page", "rsid", "l_orderkey", "l_linenumber"]
    joined = x.calls.join(pop_codes(x), "rsid").select(*keys, "gt_idx", "peptides")
    return flows.rows_with_strings(joined).select(*keys, "pepstr")


@query("pepstr_counts", "pop_counts", "select patient, chrom, pepstr, count from pop_counts")
def _(x):
    return ranks.string_counts(pop_strings(x))


@query("pepstr_totals", "pop_totals", "select pepstr, strsum from pop_totals")
def _(x):
    return ranks.string_totals(pop_strings(x))


@query("pepstr_rank", "pop_ranks", "select str_rank, pepstr, strsum from pop_ranks")
def _(x):
    return flows.peptide_rank(pop_strings(x)).select("str_rank", "pepstr", "strsum")


def encoded(x):
    strings = written(pop_strings(x))
    return ranks.rank_encode(strings, flows.peptide_rank(strings))


@query("rank_encode", "pop_strings pop_ranks",
       "select s.patient, s.chrom, s.gene_name, s.page, s.pepstr, s.rows, r.str_rank from pop_strings s "
       "join pop_ranks r on s.pepstr=r.pepstr")
def _(x):
    return encoded(x)


@query("patient_rank_lists", "pop_strings pop_ranks",
       "select patient as hg_patient, pos//50 as page, "
       "string_agg(cast(str_rank as varchar),',' order by str_rank, gene) as peptide_string_num, "
       "string_agg(gene,',' order by str_rank, gene) as gene from "
       "(select *, row_number() over (partition by patient order by str_rank, gene)-1 as pos from "
       "(select distinct patient, str_rank, gene_name as gene from pop_strings s join pop_ranks r "
       "on s.pepstr=r.pepstr) d) t group by patient, pos//50")
def _(x):
    return ranks.patient_rank_lists(encoded(x), page_items=50)


@query("strand_counts", "gene_strings",
       "select count(*) filter (where contains(peptide_string,'+') and contains(peptide_string,'-')) as \"both\", "
       "count(*) filter (where contains(peptide_string,'+') and not contains(peptide_string,'-')) as positive, "
       "count(*) filter (where contains(peptide_string,'-') and not contains(peptide_string,'+')) as negative "
       "from gene_strings")
def _(x):
    strings = flows.gene_peptides(flows.decode_genotypes(x.calls, codes(x)))
    return clean.opposite_strand_counts(strings, "peptide_string")
