"""The registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from . import alignment, bagminhash, cuckoo, license_join, mixing, outliers, quality, sos_packing, toxicity, url_trust, vector_graph, warc, whitening

QUERIES = {
    "op1_url_trust": url_trust.op1_url_trust,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_warc": warc.op3_warc,
    "op4_outliers": outliers.op4_outliers,
    "op5_quality": quality.op5_quality,
    "op6_bagminhash": bagminhash.op6_bagminhash,
    "op7_sos_packing": sos_packing.op7_sos_packing,
    "op8_license_join": license_join.op8_license_join,
    "op9_mixing": mixing.op9_mixing,
    "op10_cuckoo_dedup": cuckoo.op10_cuckoo_dedup,
    "op11_vector_graph": vector_graph.op11_vector_graph,
    "op12_whitening": whitening.op12_whitening,
    "op13_alignment": alignment.op13_alignment,
}

ORACLE_SQL = {
    "op3_warc": warc.OP3_SQL,
    "op8_license_join": license_join.OP8_SQL,
    "op9_mixing": mixing.OP9_SQL,
    "op10_cuckoo_dedup": cuckoo.OP10_SQL,
}
