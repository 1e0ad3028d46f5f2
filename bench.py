"""Headline queries, one JSON line.

Each query runs twice on the same session and the second run is reported: the first pays
for class loading and code generation once per JVM, which says nothing about the plan.
Results are written to the no-op sink, so every row of every column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.session import build_session
from plumbline.workload import catalog

HEADLINE = {
    "tender_silver_from_text": "slv_06_itens_licitacao",
    "expense_silver_from_text": "slv_09_despesas",
    "latest_period_dedup": "ddp_01_latest_period_wins",
    "current_snapshot": "gld_ct_01_itens_contrato_atuais",
    "contract_summary": "gld_ct_02_contratos_atuais_resumo",
    "contractor_ranking": "gld_ct_03_ranking_contratados",
    "agency_concentration": "gld_ct_07_relacionamento_orgao_contratado",
    "tender_competition": "gld_lc_01_concorrencia_licitacoes",
    "supplier_ranking": "gld_lc_03_ranking_fornecedores",
    "agency_supplier": "gld_lc_06_relacionamento_orgao_fornecedor",
    "agreement_collapse": "gld_cv_01_fato_convenios",
    "deputy_ranking": "gld_gd_02_ranking_deputados",
    "monthly_expenses": "gld_gd_07_resumo_mensal",
    "vote_ranking": "gld_pv_11_ranking_deputados_votos",
    "senate_suppliers": "gld_sn_06_ranking_fornecedores_ceaps",
    "canonical_beneficiary": "ddp_04_canonical_author",
    "ranged_rank": "hrd_1_ranged_partitioned_rank",
    "expense_checks": "dq_11_expenses_suite",
    "orphan_profile": "dq_09_orphan_profile",
    "yearly_reconciliation": "rec_05_amendments_by_year",
    "measures": "msr_01_05_all_measures",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="plumbline-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for label, name in HEADLINE.items():
        for _ in range(2):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[label] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total_seconds_headline_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "spark": spark.version,
        "cpus": int(cpus),
        "shuffle_partitions": int(cpus),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
