from collections import Counter

from pyspark.sql import functions as F

from genoweave.operators import drugs as dg
from genoweave.operators import ranks, reshape
from genoweave.plans import flows

SITES = [
    ("5S_rRNA", "rs12211410", "G,A,", "R,H,"), ("5S_rRNA", "rs185819", "G,A,", "R,H,"),
    ("5S_rRNA", "rs6910390", "T,C,", "M,T,"), ("7SK", "rs10081449", "T,G,", "F,C,"),
]
CALLS = [
    ("szpabr0002", "rs12211410", "A/G"), ("szpabr0002", "rs185819", "A/G"), ("szpabr0002", "rs6910390", "G/G"),
    ("szpabr0003", "rs12211410", "G/G"), ("szpabr0003", "rs185819", "G/G"), ("szpabr0003", "rs6910390", "G/G"),
    ("szpabr0003", "rs10081449", "0/0"),
]


def book(frame, **options):
    return flows.site_codes(frame("gene_name string, rsid string, alleles string, peptides string", *SITES), **options)


def calls(frame):
    return frame("patient string, rsid string, gt string", *CALLS)


def test_peptide_strings(frame):
    strings = flows.gene_peptides(flows.decode_genotypes(calls(frame), book(frame)))
    rows = {(r.patient, r.gene_name): (r.page, r.peptide_string, r.rsids) for r in strings.collect()}
    assert rows[("szpabr0002", "5S_rRNA")] == (0, "+H+R+H+R-T-T", "rs12211410,rs185819,rs6910390")
    assert rows[("szpabr0003", "5S_rRNA")][1] == "+R+R+R+R-T-T"
    # A gene without any decodable call has no string, but its ids stay.
    assert rows[("szpabr0003", "7SK")] == (0, None, "rs10081449")


def test_pages_of_a_gene_join_to_its_whole_string(frame):
    paged = book(frame, page_items=2)
    rows = flows.gene_peptides(flows.decode_genotypes(calls(frame), paged)).orderBy("page").collect()
    parts = [r.peptide_string for r in rows if (r.patient, r.gene_name) == ("szpabr0002", "5S_rRNA")]
    assert parts == ["+H+R+H+R", "-T-T"]


def test_transcripts_that_decode_alike_are_merged(frame):
    twice = frame("gene_name string, rsid string, alleles string, peptides string", *SITES, *SITES)
    assert flows.site_codes(twice).count() == len(SITES)


def test_audit_trail(frame):
    rows = flows.gene_peptides_audit(calls(frame), book(frame)).collect()
    row = next(r for r in rows if r.patient == "szpabr0002")
    assert row.trails == "A/G-G,A,-R,H,,A/G-G,A,-R,H,,G/G-T,C,-M,T,"
    assert row.peptide_string == "+H+R+H+R-T-T"


def matrix(frame, slice_columns):
    codes = book(frame)
    strings = flows.gene_peptides(flows.decode_genotypes(calls(frame), codes))
    labels = flows.feature_labels(flows.header_rsids(codes))
    patients = frame("patient string, diagnosis string", ("szpabr0002", "2"), ("szpabr0003", "2"), ("cg1", None))
    return flows.ml_matrix(strings, labels, patients, slice_columns)


def test_matrix_lines(frame):
    header, lines = matrix(frame, 900)
    assert header.first().line == (
        "'patient','diagnosis','5S_rRNA | rs12211410 rs185819 rs6910390','7SK | rs10081449'")
    assert sorted(r.line for r in lines.collect()) == [
        "'cg1','',,", "'szpabr0002','2','+H+R+H+R-T-T',", "'szpabr0003','2','+R+R+R+R-T-T',"]


def test_matrix_slices(frame):
    header, lines = matrix(frame, 1)
    assert {r.slice for r in header.collect()} == {0, 1}
    rows = {(r.patient, r.slice): r.line for r in lines.collect()}
    assert len(rows) == 6
    assert rows[("szpabr0002", 1)] == "'szpabr0002','2',"
    assert rows[("szpabr0003", 0)] == "'szpabr0003','2','+R+R+R+R-T-T'"


def test_matrix_gaps(frame):
    labels = frame("gene_name string, page long, label string", *[(f"g{i}", 0, f"g{i}") for i in range(7)])
    strings = frame("patient string, gene_name string, page long, peptide_string string",
                    ("p", "g2", 0, "+A"), ("p", "g5", 0, "-B"), ("q", "g0", 0, "+C"), ("q", "g6", 0, "+D"))
    patients = frame("patient string, diagnosis string", ("p", "1"), ("q", "2"), ("r", "1"))
    rows = {r.patient: r.line for r in flows.ml_matrix(strings, labels, patients)[1].collect()}
    assert rows == {"p": "'p','1',,,'+A',,,'-B',", "q": "'q','2','+C',,,,,,'+D'", "r": "'r','1',,,,,,,"}


def test_matrix_lines_are_spread(frame):
    """Lines without a cell are most of a paged matrix; no task makes them all, and none is lost or made twice."""
    labels = frame("gene_name string, page long, label string", *[(f"G{k:03}", 0, f"'G{k:03}'") for k in range(95)])
    cells = {(f"p{k}", f"G{(k * 7 + j) % 95:03}"): f"+{j}" for k in range(30) for j in range(k % 4)}
    strings = frame("patient string, gene_name string, page long, peptide_string string", *[(p, g, 0, c) for (p, g), c in cells.items()])
    patients = [(f"p{k}", "1" if k % 5 else None) for k in range(30)] + [("p3", "2"), (None, "1")]
    lines = flows.ml_matrix(strings, labels, frame("patient string, diagnosis string", *patients), 10)[1]

    def line(patient, diagnosis, k):
        names = [f"G{j:03}" for j in range(10 * k, min(10 * k + 10, 95))]
        found = ",".join(f"'{cells[patient, g]}'" if (patient, g) in cells else "" for g in names)
        return None if patient is None else f"'{patient}','{diagnosis or ''}',{found}"

    wanted = Counter((p, k, line(p, d, k)) for p, d in patients for k in range(10))
    assert Counter((r.patient, r.slice, r.line) for r in lines.collect()) == wanted
    assert lines.select(F.spark_partition_id().alias("task")).distinct().count() > 4


def test_wide_matrix(frame):
    strings = frame("patient string, label string, peptide_string string", ("a", "g1", "+A"), ("a", "g2", "-B"), ("b", "g2", "+C"))
    rows = {r.patient: (r.g1, r.g2) for r in reshape.to_wide(strings, ["g1", "g2"]).collect()}
    assert rows == {"a": ("+A", "-B"), "b": (None, "+C")}
    back = reshape.to_wide(strings, ["g1", "g2"]).unpivot("patient", ["g1", "g2"], "label", "peptide_string")
    assert {tuple(r) for r in back.filter("peptide_string is not null").collect()} == {tuple(r) for r in strings.collect()}


def pepstrings(frame):
    """24 chromosomes with 4 rows for each of eleven patients."""
    first = [("p01", s) for s in ("abc", "abc", "abc", "def")]
    second = [("p02", s) for s in ("abc", "abc", "def", "def")]
    rest = [(f"p{n:02}", "SSSSSSSS") for n in range(3, 12) for _ in range(4)]
    rows = [(p, "EEF1DP3_gene", s) for p, s in first + second + rest]
    once = frame("patient string, gene_name string, pepstr string", *rows)
    return once.withColumn("chrom", F.explode(F.sequence(F.lit(1), F.lit(24))))


def test_string_counts_ranks_and_lists(frame):
    strings = pepstrings(frame)
    counts = ranks.string_counts(strings)
    per_patient = counts.groupBy("patient", "pepstr").agg(F.sum("count").alias("n")).collect()
    found = {(r.patient, r.pepstr): r.n for r in per_patient}
    assert found[("p01", "abc")] == 72 and found[("p01", "def")] == 24
    assert found[("p02", "abc")] == 48 and found[("p02", "def")] == 48
    assert [found[(f"p{n:02}", "SSSSSSSS")] for n in range(3, 12)] == [96] * 9
    assert counts.agg(F.sum("count")).first()[0] == strings.count()
    ranked = flows.peptide_rank(strings)
    assert {(r.str_rank, r.pepstr, r.strsum) for r in ranked.collect()} == {
        (1, "SSSSSSSS", 864), (2, "abc", 120), (3, "def", 72)}
    encoded = ranks.rank_encode(strings, ranked)
    lists = {r.hg_patient: (r.peptide_string_num, r.gene) for r in ranks.patient_rank_lists(encoded).collect()}
    assert lists["p01"] == ("2,3", "EEF1DP3_gene,EEF1DP3_gene")
    assert lists["p03"] == ("1", "EEF1DP3_gene")
    assert len(lists) == 11


def test_rows_may_stand_for_several(frame):
    strings = frame("patient string, chrom string, pepstr string, rows long", ("a", "1", "x", 3), ("a", "1", "x", 4), ("a", "1", None, 9))
    assert [tuple(r) for r in ranks.string_counts(strings).collect()] == [("a", "1", "x", 7)]


def test_population_strings(frame):
    sites = frame("chrom string, gene_name string, rsid string, alleles string, peptides string",
                  *[("1", "EEF1DP3", f"rs{i}", "A,G,", "S,S,") for i in range(4)])
    rows = [(p, f"rs{i}", g) for p, g in (("hg00096", "1|0"), ("hg00097", "0|1")) for i in range(4)]
    found = flows.population_strings(
        frame("patient string, rsid string, gt_idx string", *rows, ("hg00099", "rs1", "./.")),
        flows.site_codes(sites, ("chrom", "gene_name")))
    assert {(r.patient, r.pepstr, r.rows) for r in found.collect()} == {
        ("hg00096", "SSSSSSSS", 4), ("hg00097", "SSSSSSSS", 4), ("hg00099", None, 1)}
    attached = flows.with_gene_strings(
        frame("patient string, chrom string, gene_name string, page long, rsid string", ("hg00096", "1", "EEF1DP3", 0, "rs2")), found)
    assert attached.first().pepstr == "SSSSSSSS"


def test_strings_on_rows_take_one_shuffle(frame):
    rows = frame(
        "patient string, chrom string, gene_name string, page long, rsid string, gt_idx string, peptides string, n int",
        ("a", "1", "G", 0, "rs2", "0|1", "R,H,", 1), ("a", "1", "G", 0, "rs1", "1", "S,T,", 2),
        ("a", "1", "G", 0, "rs2", "0|1", "R,H,", 3), ("a", "1", "G", 0, "rs2", "0|0", "R,H,", 4),
        ("a", "1", "G", 0, "rs2", "./.", "R,H,", 5), ("a", "1", "G", 0, "rs2", "0|1:9", "R,H,", 6),
        ("a", "1", "G", 1, "rs2", "./.", "R,H,", 7), ("b", "1", "G", 0, "rs2", None, "R,H,", 8),
        ("b", "2", "G", 0, "rs2", "1|1", "R,H,", 9), ("b", "2", "G", 0, "rs2", "1|1", "R,H,", 9),
        (None, "1", "G", 0, "rs1", "1", "S,T,", 10), ("a", "1", None, 0, "rs1", "1", "S,T,", 11))
    found = flows.rows_with_strings(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    joined = flows.with_gene_strings(rows, flows.pair_strings(rows)).select(found.columns)
    ours = Counter(map(tuple, found.collect()))
    assert ours == Counter(map(tuple, joined.collect()))
    assert {(r[-2], r[-1]) for r in ours} == {(n, "TRHRR") for n in range(1, 7)} | {(7, None), (8, None), (9, "HH")}


def drug_tables(frame):
    categories = ["analgesics", "anti-inflammatory agents", "cyclooxygenase inhibitors", "non-narcotic", "non-steroidal"]
    return {
        "drugs": frame("id string, name string", ("d1", "IBUPROFEN"), ("d2", "QUERCETIN"), ("d3", "UNUSED")),
        "drug_claims_drugs": frame("drug_id string, drug_claim_id string", ("d1", "dc1"), ("d2", "dc2"), ("d3", "dc3")),
        "genes": frame("id string, name string", ("g1", "PTGS2"), ("g2", "ECI1"), ("g3", "ALT")),
        "gene_claims_genes": frame("gene_id string, gene_claim_id string", ("g1", "gc1"), ("g1", "gc1b"), ("g2", "gc2")),
        "interaction_claims": frame("drug_claim_id string, gene_claim_id string", ("dc1", "gc1"), ("dc1", "gc1b"), ("dc2", "gc1"), ("dc2", "gc2")),
        "drug_claim_attributes": frame(
            "drug_claim_id string, name string, value string",
            *[("dc1", "Drug Categories", c) for c in categories], ("dc1", "Drug Categories", categories[0]),
            ("dc1", "Drug Groups", "approved"), ("dc2", "Drug Categories", "antioxidants")),
        "gene_gene_interaction_claims": frame("gene_id string, interacting_gene_id string", ("g1", "g3"), ("g2", "g3"), ("g3", "g1")),
    }


IBUPROFEN = "IBUPROFEN{analgesics/anti-inflammatory agents/cyclooxygenase inhibitors/non-narcotic/non-steroidal}"


def test_drug_texts(frame):
    rows = {r.gene_name: (r.page, r.drugs_info) for r in flows.drug_gene_table(drug_tables(frame)).collect()}
    assert rows == {"PTGS2": (0, f"{IBUPROFEN} QUERCETIN{{antioxidants}}"), "ECI1": (0, "QUERCETIN{antioxidants}")}


def test_alternative_genes_take_the_drugs_of_their_partners(frame):
    tables = drug_tables(frame)
    info = flows.alt_drug_gene_table(tables)
    rows = {r.gene_name: r.drugs_info for r in info.collect()}
    assert rows == {"ALT": f"{IBUPROFEN} QUERCETIN{{antioxidants}}"}
    hops = dg.alternative_genes(tables["genes"], tables["gene_gene_interaction_claims"])
    named = dg.with_interacting_names(info, dg.alternative_pairs(tables["genes"], hops))
    assert {(r.gene_name, r.interactive_gene_name) for r in named.collect()} == {("ALT", "PTGS2"), ("ALT", "ECI1")}
    assert dg.alternative_claims(hops, tables["gene_claims_genes"]).count() == 3


def test_sites_of_genes_with_drugs(frame):
    info = flows.drug_gene_table(drug_tables(frame))
    sites = frame("gene_name string, rsid string", ("ECI1", "rs2302584"), ("ECI1", "rs26840"), ("OTHER", "rs1"))
    kept = dg.keep_genes_with_drugs(sites, info)
    assert {r.rsid for r in kept.collect()} == {"rs2302584", "rs26840"}
    tables = drug_tables(frame)
    claims = dg.gene_drug_claims(dg.gene_claims(tables["genes"], tables["gene_claims_genes"]), tables["interaction_claims"])
    names = dg.drug_names(tables["drugs"], tables["drug_claims_drugs"])
    genes = dg.genes_with_drugs(claims, names, tables["drug_claim_attributes"])
    assert {r.gene_name for r in genes.collect()} == {r.gene_name for r in info.collect()}
    rsids = frame("gene_name string, page long, rsids string", ("ECI1", 0, "rs2302584 rs26840"), ("OTHER", 0, "rs1"))
    labels = flows.feature_labels_with_drugs(rsids, dg.header_drugs(sites, info)).collect()
    assert [r.label for r in labels] == ["'ECI1 | rs2302584 rs26840 | QUERCETIN{antioxidants}'"]


def test_long_drug_texts_go_on_in_labels_of_their_own(frame):
    rsids = frame("gene_name string, page long, rsids string", ("G", 0, "rs1"))
    drugs = frame("gene_name string, drugs_page long, gene_drugs string", ("G", 0, "A{x}"), ("G", 1, "B{y}"), ("H", 0, "C{z}"))
    labels = {r.page: r.label for r in flows.feature_labels_with_drugs(rsids, drugs).collect()}
    assert labels == {0: "'G | rs1 | A{x}'", 1: "'G | B{y}'"}


def test_totals_of_strings_without_a_count_per_patient(frame):
    """The same as over patients and chromosomes, from the strings themselves."""
    rows = [("p", "1", "AR", 2), ("p", "2", "AR", 3), ("q", "1", "AR", 1), ("q", "1", None, 9), (None, "1", "K", 4), ("p", "1", "AR", 2)]
    strings = frame("patient string, chrom string, pepstr string, rows long", *rows)
    direct = ranks.string_totals(strings)
    assert {(r.pepstr, r.strsum) for r in direct.collect()} == {("AR", 8), ("K", 4)}
    assert sorted(direct.collect()) == sorted(ranks.string_totals(ranks.string_counts(strings)).collect())
