"""SQL for the queries of this subpackage, where SQL can express them."""

ORACLE = {
    "p3_found": """
WITH RECURSIVE e AS (
  SELECT candidate_id_a AS u, candidate_id_b AS v FROM candidate_pair WHERE candidate_id_a IS NOT NULL AND candidate_id_b IS NOT NULL
  UNION SELECT candidate_id_b, candidate_id_a FROM candidate_pair WHERE candidate_id_a IS NOT NULL AND candidate_id_b IS NOT NULL
), n AS (
  SELECT candidate_id_a AS u FROM candidate_pair WHERE candidate_id_a IS NOT NULL
  UNION SELECT candidate_id_b FROM candidate_pair WHERE candidate_id_b IS NOT NULL
), r AS (
  SELECT u, u AS g FROM n
  UNION SELECT e.v, r.g FROM r JOIN e ON e.u = r.u
)
SELECT u AS candidate_id, min(g) AS group_id FROM r GROUP BY u
""",
}
