"""Score requests from a topic as they come.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2 \\
        -m tiffin.jobs.score_stream --out responses/ --checkpoint checkpoints/scoring

Addresses and topics come from the environment: KAFKA_BOOTSTRAP, REQUEST_TOPIC,
RESPONSE_TOPIC, MODEL_DIR, CHECKPOINT_DIR.
"""

from __future__ import annotations

import argparse
import os

from tiffin.plans.training import load_model, model_path
from tiffin.schemas import LATE_LIMIT, REQUEST_TOPIC, RESPONSE_TOPIC
from tiffin.session import build_session, stream_session
from tiffin.sources.messages import request_source
from tiffin.streaming.ledger import BatchLedger
from tiffin.streaming.scoring import response_document, response_with_context, start_scoring
from tiffin.streaming.sinks import Sink, document_sink, message_sink, search_sink

SHAPES = {"context": response_with_context, "document": response_document}


def main(argv: list[str] | None = None) -> None:
    env = os.environ.get
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--source", default="kafka", help="kafka, or a file format")
    parser.add_argument("--input", help="folder of message files, for a file format")
    parser.add_argument("--servers", default=env("KAFKA_BOOTSTRAP"))
    parser.add_argument("--topic", default=env("REQUEST_TOPIC", REQUEST_TOPIC))
    parser.add_argument("--response-topic", default=env("RESPONSE_TOPIC", RESPONSE_TOPIC))
    parser.add_argument("--starting", default="latest", choices=["latest", "earliest"])
    parser.add_argument("--option", action="append", default=[], help="source option name=value")
    parser.add_argument("--model", default="models/pipeline_model")
    parser.add_argument("--fallback-model", default="models/best_pipeline")
    parser.add_argument("--out", required=True, help="folder for documents, bulk text and errors")
    parser.add_argument("--checkpoint", default=env("CHECKPOINT_DIR"))
    parser.add_argument("--shape", default="context", choices=list(SHAPES))
    parser.add_argument("--late-limit", default=LATE_LIMIT)
    parser.add_argument("--dedup-spread", type=int, default=1)
    parser.add_argument("--state-partitions", type=int)
    parser.add_argument("--files-per-batch", type=int, help="joins partitions for the sinks")
    parser.add_argument("--available-now", action="store_true", help="stop at the end of input")
    parser.add_argument("--master")
    args = parser.parse_args(argv)
    if not args.checkpoint:
        parser.error("--checkpoint or CHECKPOINT_DIR is needed: a stream without one cannot restart")

    spark = build_session("tiffin-scoring", args.master)
    model = load_model(model_path(spark, args.fallback_model, args.model))
    session = stream_session(spark, args.state_partitions)
    messages = request_source(
        session,
        args.source,
        args.input,
        args.topic,
        args.servers,
        args.starting,
        **dict(option.split("=", 1) for option in args.option),
    )
    if args.source == "kafka":
        responses = message_sink("kafka", topic=args.response_topic, servers=args.servers)
    else:
        responses = message_sink("json", f"{args.out}/messages")
    stream = start_scoring(
        messages,
        model,
        [
            Sink("search", search_sink(f"{args.out}/search"), on_error="continue"),
            Sink("messages", responses),
            Sink("documents", document_sink(f"{args.out}/documents")),
        ],
        checkpoint=args.checkpoint,
        errors=f"{args.out}/errors",
        rejects=f"{args.out}/rejects",
        available_now=args.available_now,
        late_limit=args.late_limit,
        spread=args.dedup_spread,
        shape=SHAPES[args.shape],
        files=args.files_per_batch,
        batch_log=BatchLedger(spark, f"{args.out}/batches"),
        commits=f"{args.out}/commits",
        held=f"{args.out}/held",
    )
    stream.awaitTermination()


if __name__ == "__main__":
    main()
