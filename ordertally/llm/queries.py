"""The queries of this subpackage, by the names the driver knows."""

from __future__ import annotations

from ordertally.llm.chat import op11_chat
from ordertally.llm.exact_dedup import OP3_SQL, op3_exact_dedup
from ordertally.llm.fingerprints import op1_fingerprints
from ordertally.llm.language import op10_language
from ordertally.llm.mixing import op7_mixing
from ordertally.llm.packing import op5_packing
from ordertally.llm.quality import op4_quality
from ordertally.llm.repair import op12_repair
from ordertally.llm.search import OP13_SQL, op13_search
from ordertally.llm.similarity import op2_similarity
from ordertally.llm.substrings import OP9_SQL, op9_substrings
from ordertally.llm.token_files import op8_token_ids
from ordertally.llm.warc import op6_warc

QUERIES = {
    query.__name__: query
    for query in (
        op1_fingerprints,
        op2_similarity,
        op3_exact_dedup,
        op4_quality,
        op5_packing,
        op6_warc,
        op7_mixing,
        op8_token_ids,
        op9_substrings,
        op10_language,
        op11_chat,
        op12_repair,
        op13_search,
    )
}
ORACLES: dict[str, str] = {
    "op3_exact_dedup": OP3_SQL,
    "op9_substrings": OP9_SQL,
    "op13_search": OP13_SQL,
}
