"""Random small graphs against plain Python."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spark_triples.operators import documents, prospects
from spark_triples.operators.triples import dedup_triples
from spark_triples.schema import ANYURI, DELIM, XSD, XSD_STRING

from .fixtures import counts_of
from .test_documents import whole

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
GRAPHS = st.lists(
    st.tuples(
        st.sampled_from(["urn:a#1", "urn:a#2", "http://b/c/d", "urn:x", "http://b/c#"]),
        st.sampled_from(["urn:p", "urn:q"]),
        st.sampled_from(["", "1", "|", "é", "a b", "urn:x"]),
        st.sampled_from([XSD_STRING, XSD + "integer", ANYURI]),
        st.sampled_from([None, "en"]),
    ),
    max_size=60,
)


def namespace(iri):
    for separator in ("#", "/", ":"):
        if separator in iri:
            head, tail = iri.split("#", 1) if separator == "#" else iri.rsplit(separator, 1)
            return head


@FEW
@given(GRAPHS)
def test_counts(make_triples, rows):
    expected = Counter()
    for s, p, o, kind, _ in set(rows):
        expected.update(
            [
                ("subject", s, ANYURI),
                ("predicate", p, ANYURI),
                ("object", o, kind),
                ("subjectpredicate", s + DELIM + p, XSD_STRING),
                ("subjectobject", s + DELIM + o, XSD_STRING),
                ("predicateobject", p + DELIM + o, XSD_STRING),
                ("entity", namespace(s), ANYURI),
            ]
        )
    triples = dedup_triples(make_triples(rows))
    assert counts_of(prospects.prospect_counts(triples)) == expected


@FEW
@given(GRAPHS, st.integers(1, 300))
def test_documents(make_triples, rows, part_chars):
    expected = defaultdict(lambda: ({}, []))
    ordered = sorted(set(rows), key=lambda r: (*r[:3], r[3], r[4] or ""))
    for s, p, o, kind, _ in ordered:
        fields, text = expected[s]
        if kind != ANYURI:
            fields.setdefault(f"p_{p}", []).append(o)
            text.append(o)
    triples = dedup_triples(make_triples(rows))
    values = documents.document_values(triples)
    docs = documents.nest_documents(values, part_chars, broadcast_keys=part_chars % 3)
    assert whole(docs) == expected
