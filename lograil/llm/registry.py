"""The corpus operators' queries, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from . import decontamination, line_dedup, near_dup, neighbours, pieces, pipeline, secrets, sharding, token_counts, token_files, toxicity


def queries() -> dict:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_neighbours": neighbours.op2_neighbours,
        "op3_decontamination": decontamination.op3_decontamination,
        "op4_line_dedup": line_dedup.op4_line_dedup,
        "op5_pieces": pieces.op5_pieces,
        "op6_secrets": secrets.op6_secrets,
        "op7_token_files": token_files.op7_token_files,
        "op8_near_duplicates": near_dup.op8_near_duplicates,
        "op9_token_counts": token_counts.op9_token_counts,
        "op10_sharding": sharding.op10_sharding,
        "pipeline": pipeline.run,
    }


def oracles() -> dict[str, str]:
    return {
        "op3_decontamination": decontamination.ORACLE_OP3,
        "op4_line_dedup": line_dedup.ORACLE_OP4,
        "op6_secrets": secrets.ORACLE_OP6,
        "op8_near_duplicates": near_dup.ORACLE_OP8,
    }
