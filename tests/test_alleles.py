import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from genoweave.functions import alleles as al

CASES = [
    # genotype, alleles, peptides, expected
    ("A/A", "T,G,", "F,C,", "-F-F"),
    ("G/G", "G,C,T,", "K,N,N,", "+K+K"),
    ("G/G", "T,C,", "M,T,", "-T-T"),
    ("A/G", "G,A,", "R,H,", "+H+R"),
    ("G/G", "G,A,", "R,H,", "+R+R"),
    ("0/0", "G,A,", "R,H,", None),
    ("A/0", "G,A,", "R,H,", None),
    ("A/G/A", "G,A,", "R,H,", "+H+R+H"),
    ("A/G/0", "G,A,", "R,H,", None),
    ("A", "G,A,", "R,H,", "+H+"),  # an empty haplotype matches the empty third allele
    ("A", "G,A,C,", "R,H,P,", None),
    ("2", "G,A,", "R,H,", None),
    ("A/T", "A,T,", "R,H,", "+R+H"),  # own strand wins at a palindromic site
    (None, "G,A,", "R,H,", None),
]


def decode(frame, *rows):
    df = frame("n int, gt string, alleles string, peptides string",
               *[(i, *row) for i, row in enumerate(rows)])
    value = al.genotype_peptides(
        F.col("gt"), al.code_letters(F.col("alleles")), al.code_peptides(F.col("peptides")))
    return [r.v for r in df.select("n", value.alias("v")).orderBy("n").collect()]


def test_decode_cases(frame):
    assert decode(frame, *[c[:3] for c in CASES]) == [c[3] for c in CASES]


def by_definition(gt, alleles, peptides):
    """The decoding read straight from its definition."""
    a = [alleles[i : i + 1] for i in (0, 2, 4)]
    p = [peptides[i : i + 1] for i in (0, 2, 4)]
    o = [al.OPPOSITE_BASE.get(x) for x in a]

    def one(letter):
        for side, sign in ((a, "+"), (o, "-")):
            for n in range(3):
                if side[n] is not None and side[n] == letter:
                    return sign + p[n]
        return None

    third = gt[4:5]
    parts = [one(gt[0:1]), one(gt[2:3]), "" if third == "" else one(third)]
    return None if None in parts else "".join(parts)


letters = st.sampled_from("ACGT0N-")
genotypes = st.lists(letters, min_size=1, max_size=3).map("/".join)
lists = st.lists(st.sampled_from("ACGT"), min_size=2, max_size=3).map(lambda v: ",".join(v) + ",")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(genotypes, lists, lists), min_size=20, max_size=60))
def test_decode_follows_its_definition(frame, rows):
    assert decode(frame, *rows) == [by_definition(*row) for row in rows]


def test_flipping_the_strand_flips_the_signs(frame):
    # Two-allele sites whose alleles are no base pair of each other.
    sites = [("G,A,", "R,H,"), ("T,C,", "M,T,"), ("A,C,", "K,N,"), ("G,T,", "A,S,")]
    calls = [f"{x}/{y}" for x in "ACGT" for y in "ACGT"]
    flip = str.maketrans(al.OPPOSITE_BASE)
    plain = decode(frame, *[(c, a, p) for c in calls for a, p in sites])
    flipped = decode(frame, *[(c.translate(flip), a, p) for c in calls for a, p in sites])
    signs = str.maketrans("+-", "-+")
    assert [None if v is None else v.translate(signs) for v in plain] == flipped


def test_opposite_bases(frame):
    df = frame("b string", *[(b,) for b in "GCATN-"], ("",), (None,))
    flipped = al.opposite(F.col("b"))
    rows = df.select(flipped.alias("o"), al.opposite(flipped).alias("oo"), "b").collect()
    assert [r.o for r in rows] == ["C", "G", "T", "A", None, None, None, None]
    assert [r.oo for r in rows][:4] == list("GCAT")


def test_allele_and_opposite_slots(frame):
    df = frame("alleles string", ("G,A,",), ("G,T,",), ("G,C,T,",))
    rows = al.with_opposite_slots(al.with_allele_slots(df)).collect()
    assert [(r.allele1, r.allele2, r.allele3) for r in rows] == [
        ("G", "A", ""), ("G", "T", ""), ("G", "C", "T")]
    assert [(r.opallele1, r.opallele2, r.opallele3) for r in rows] == [
        ("C", "T", None), ("C", "A", None), ("C", "G", "A")]


@pytest.mark.parametrize(
    ("gt", "peptides", "expected"),
    [("1|0", "S,S,", "SS"), ("0|1", "R,H,", "RH"), ("1/1", "R,H,", "HH"), ("./.", "R,H,", None),
     ("2|0", "K,N,T,", "TK"), ("2|0", "R,H,", None), ("0", "R,H,", "R"),
     ("1:35", "R,H,", "H"), ("0|1:35:7", "R,H,", "RH"), (".", "R,H,", None), ("2", "R,H,", None)],
)
def test_allele_numbers(frame, gt, peptides, expected):
    df = frame("gt string, peptides string", (gt, peptides))
    assert df.select(al.index_peptides(F.col("gt"), F.col("peptides"))).first()[0] == expected


def test_calls_are_split_once_however_often_their_parts_are_used(frame):
    df = frame("gt string, peptides string", ("1|0", "R,H,"), ("./.", "R,H,"), (".|1", "R,H,"), (None, "R,H,"), ("0", None))
    found = al.with_index_peptides(df, "gt", "peptides", "pair")
    assert [r.pair for r in found.collect()] == ["HR", None, None, None, None]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 2
    assert found.columns == ["gt", "peptides", "pair"]
