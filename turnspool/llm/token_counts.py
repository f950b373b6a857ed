"""Token counts of whole texts by a compiled tokenizer (``transducer``), in place, without a shuffle.

The transducer is compiled once on the driver from the pieces of a sentencepiece BPE model and
broadcast; its size is that of the vocabulary. Tasks that run in one Python worker share the pairs
of pieces they have come across, in a table of bounded size.

Models must leave characters as they are, put one blank before a text, and write characters that
they lack as bytes; ``load_transducer`` tries that out and refuses others.

A null text is an empty one: no bytes, no tokens. Texts are taken whole, however long; a long one is
cut in chunks inside its task, with some 200 bytes of memory a chunk of 128 characters. Ids, ties,
repeated rows and nulls in other columns make no difference. Extra columns stay, and the result
columns replace columns of their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnspool.llm.transducer import Transducer
from turnspool.llm.words import slices, utf8

# What models that change characters, blanks or unknown characters would count otherwise.
PROBES = ["", " ", "a", "  a  b ", "ﬁ Ⅷ ㍿ é 　", "\t\n\x00", "▁▁a▁", "<s></s><unk><0x0A>"]


def load_transducer(path: str) -> Transducer:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    transducer = Transducer({model.id_to_piece(i): model.get_score(i) for i in normal})
    want = [len(ids) for ids in model.encode(PROBES, num_threads=1)]
    if transducer.count(*utf8(pa.array(PROBES))).tolist() != want:
        raise ValueError(f"{path} is no plain byte-pair model")
    return transducer


def counts_udf(shared):
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        transducer = shared.value
        for column in columns:
            sizes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, data, bounds in slices(column):
                sizes.append(np.diff(bounds))
                counts.append(transducer.count(data, bounds))
            arrays = [pa.array(np.concatenate(x).astype(np.int64)) for x in (sizes, counts)]
            yield pa.StructArray.from_arrays(arrays, names=["n_bytes", "n_tokens"])

    return F.arrow_udf(run, "n_bytes bigint, n_tokens bigint")


def count_tokens(df: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``df`` with ``n_bytes`` (UTF-8) and ``n_tokens``."""
    shared = df.sparkSession.sparkContext.broadcast(load_transducer(model_path))
    carried = [F.col(f"`{c}`") for c in df.columns if c not in ("n_bytes", "n_tokens")]
    counted = df.select(
        F.struct(F.lit(0).alias("_"), *carried).alias("row"),
        counts_udf(shared)(F.col(f"`{text_col}`")).alias("found"),
    )
    return counted.select("row.*", "found.*").drop("_")
