"""The registered queries of this subpackage and, where SQL can say the same, their DuckDB SQL."""

from __future__ import annotations

from tidewater.llm import (decontaminate, divergence, filteraudit, langid, linededup, packing, passages, pii, quality, secrets,
                           simhash, tokenbin, warc)

QUERIES = {
    "op1_langid": langid.op1_langid,
    "op2_simhash": simhash.op2_simhash,
    "op3_quality": quality.op3_quality,
    "op4_tokens": tokenbin.op4_tokens,
    "op5_lines": linededup.op5_lines,
    "op6_packing": packing.op6_packing,
    "op7_warc": warc.op7_warc,
    "op8_decontamination": decontaminate.op8_decontamination,
    "op9_secrets": secrets.op9_secrets,
    "op10_passages": passages.op10_passages,
    "op11_pii": pii.op11_pii,
    "op12_filters": filteraudit.op12_filters,
    "op13_divergence": divergence.op13_divergence,
}
ORACLE: dict[str, str] = {
    "op3_quality": quality.OP3_SQL,
    "op7_warc": warc.OP7_SQL,
    "op12_filters": filteraudit.OP12_SQL,
    "op13_divergence": divergence.OP13_SQL,
}
