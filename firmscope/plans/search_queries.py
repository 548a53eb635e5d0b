"""Full-text queries over parts as entities with variants of their names."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from firmscope.operators import search as Q
from firmscope.operators.tables import shared_dir
from firmscope.plans.extract_queries import values
from firmscope.plans.registry import query

TEXT = "concat_ws(' ', p_name, p_type, CASE WHEN p_partkey % 3 = 0 THEN 'the ' || p_name WHEN p_partkey % 7 = 1 THEN 'widgets of ' || lower(p_type) || ' and old plates, rings; new rings' END, p_brand)"
ASKED = [(1, "Cold widgets"), (2, "the blue plates"), (3, "small ECONOMY"), (4, "Gizmos"), (5, "red red rings"), (6, "of the"), (7, "large anvil, promo"), (8, "brand 7"), (9, "unheard widget"), (10, "new ring brand standard"), (11, "")]
#: The terms asked for, as the vocabulary's words whose stems they are.
_terms = [(1, "cold"), (1, "widget"), (2, "blue"), (2, "plate"), (3, "small"), (3, "economy"), (4, "gizmo"), (5, "red"), (5, "ring"), (7, "large"), (7, "anvil"), (7, "promo"), (8, "brand"), (8, "7"), (9, "unheard"), (9, "widget"), (10, "new"), (10, "ring"), (10, "brand"), (10, "standard")]


@query(
    f"WITH d AS (SELECT p_partkey AS id, list_transform(regexp_extract_all(lower({TEXT}), '[a-z0-9]+'), lambda w: CASE WHEN w IN ('widgets', 'plates', 'rings') THEN substr(w, 1, length(w) - 1) ELSE w END) AS w FROM part), t AS (SELECT query_id, term FROM {values(_terms, 'query_id, term')}), n AS (SELECT query_id, count(*) AS n FROM t GROUP BY 1),"
    " p AS (SELECT id, unnest(w) AS term, generate_subscripts(w, 1) AS spot FROM d), h AS (SELECT query_id, id, t.term, spot, row_number() OVER (PARTITION BY query_id, id, t.term ORDER BY spot) AS i FROM t JOIN p ON p.term = t.term),"
    " m AS (SELECT query_id, id, n FROM h JOIN n USING (query_id) GROUP BY ALL HAVING count(DISTINCT term) = n), one AS (SELECT query_id, id, sum(0.1::DOUBLE / (i * i)) / 1.64493406685 AS rank FROM h JOIN m USING (query_id, id) WHERE n = 1 GROUP BY 1, 2),"
    " two AS (SELECT a.query_id, a.id, 1 - exp(sum(ln(1 - 0.1 * sqrt(CASE WHEN abs(a.spot - b.spot) > 100 THEN 1e-30 ELSE 1 / (1.005 + 0.05 * exp(abs(a.spot - b.spot) / 1.5::DOUBLE - 2)) END)))) AS rank FROM h a JOIN h b ON a.query_id = b.query_id AND a.id = b.id AND a.term < b.term JOIN m ON m.query_id = a.query_id AND m.id = a.id GROUP BY 1, 2),"
    " r AS (SELECT query_id, id, round(rank, 9)::DOUBLE AS rank FROM (SELECT * FROM one UNION ALL SELECT * FROM two)) SELECT query_id, id, rank, row_number() OVER (PARTITION BY query_id ORDER BY rank DESC, id) AS place FROM r QUALIFY place <= 20"
)
def full_text_search(t):
    """Several searches by one index, written to the shared folder; the `top` of 20 is the feature."""
    folder = f"{shared_dir(t.spark).rstrip('/')}/index-{uuid.uuid4().hex}"
    Q.write_index(t.part, "p_partkey", F.expr(TEXT), folder)
    return Q.search(t.spark, folder, t.spark.createDataFrame(ASKED, "query_id long, text string"))
