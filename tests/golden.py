"""The 25-row inspection sheet of the original process, rebuilt from what its
tests and process document state (see FIXTURES.md section 1)."""

from __future__ import annotations

from lotguard.functions import constants as K

REFERENCE_DATE = "14/06/2026"
SOURCE_HASH = "f" * 64


def golden_rows() -> list[dict]:
    rows = []
    for i in range(25):
        rows.append({
            "lote_id": f"LG-2026-00{101 + i}",
            "produto": K.CATALOGUE[i % 10],
            "linha": f"L{i % 3 + 1}",
            "turno": "ABC"[i % 3],
            "status": "APROVADO",
            "responsavel": f"Operador {i}",
            "data": REFERENCE_DATE,
            "observacao": None,
        })
    rows[4]["status"] = "OK"
    rows[6]["status"] = "NOK"
    rows[8]["responsavel"] = ""
    rows[11]["status"] = "REPROV."
    rows[14]["data"] = "15/06/2026"
    rows[17]["status"] = "APROVADO PARCIAL"
    rows[20]["status"] = "REPROVADO"
    rows[23]["lote_id"] = ""
    for i, r in enumerate(rows):
        r.update({
            "batch_id": "batch-" + SOURCE_HASH[:16],
            "row_idx": i,
            "source_row": i + 4,
            "item_id": f"{SOURCE_HASH}:{i + 4}",
            "source_hash": SOURCE_HASH,
            "source_file": "inspecao_lotes_dia.xlsx",
            "reference_date": REFERENCE_DATE,
        })
    return rows


def reference_ids() -> list[str]:
    return [f"LG-2026-00{n}" for n in range(101, 126) if n not in (103, 124)]


SCHEMA = ("batch_id string, row_idx int, source_row int, item_id string, source_hash string, "
          "source_file string, reference_date string, "
          + ", ".join(f"{c} string" for c in K.CONTRACT_COLUMNS))


def golden_df(spark):
    cols = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in golden_rows()], SCHEMA)


def reference_df(spark):
    return spark.createDataFrame([(x,) for x in reference_ids()], "lote_id string")
