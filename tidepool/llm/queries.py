"""The queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from tidepool.llm.alignment import op12_alignment
from tidepool.llm.caps import op8_caps
from tidepool.llm.jaccard import op7_jaccard
from tidepool.llm.langid import op13_langid
from tidepool.llm.licenses import op5_licenses
from tidepool.llm.lloyd import OP11_SQL, op11_lloyd
from tidepool.llm.mixing import op1_mixing
from tidepool.llm.packing import op4_packing
from tidepool.llm.secrets import op10_secrets
from tidepool.llm.sharding import op6_sharding
from tidepool.llm.topk import OP3_SQL, op3_topk
from tidepool.llm.toxicity import op2_toxicity
from tidepool.llm.warc import op9_warc

QUERIES = {
    "op1_mixing": op1_mixing,
    "op4_packing": op4_packing,
    "op6_sharding": op6_sharding,
    "op9_warc": op9_warc,
    "op3_topk": op3_topk,
    "op7_jaccard": op7_jaccard,
    "op8_caps": op8_caps,
    "op10_secrets": op10_secrets,
    "op2_toxicity": op2_toxicity,
    "op5_licenses": op5_licenses,
    "op11_lloyd": op11_lloyd,
    "op12_alignment": op12_alignment,
    "op13_langid": op13_langid,
}

ORACLES: dict[str, str] = {
    "op3_topk": OP3_SQL,
    "op11_lloyd": OP11_SQL,
}
