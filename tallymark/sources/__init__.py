"""Tables at the edges of the engine."""

from tallymark.sources.sinks import (
    image_manifest,
    rejects,
    report_rows,
    write_eval_samples,
    write_image_manifest,
    write_jsonl,
    write_rejects,
    write_report,
)
from tallymark.sources.tables import (
    local_path,
    scan_images,
    scan_jsonl,
    scan_jsonl_positions,
    scan_problems,
    scan_teacher,
    split_bad_lines,
    teacher_successes,
    with_positions,
)

__all__ = [
    "image_manifest",
    "local_path",
    "rejects",
    "report_rows",
    "scan_images",
    "scan_jsonl",
    "scan_jsonl_positions",
    "scan_problems",
    "scan_teacher",
    "split_bad_lines",
    "teacher_successes",
    "with_positions",
    "write_eval_samples",
    "write_image_manifest",
    "write_jsonl",
    "write_rejects",
    "write_report",
]
