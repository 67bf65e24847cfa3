"""quillspark: instruction-tuning data preparation as Spark DataFrame jobs.

Sub-packages:

* ``functions``  Column builders shared by every operator (Python-compatible
  whitespace/strip, stable hash ordering, global row index).
* ``operators``  the data operators (chunking, chat logs, QA parsing,
  conversation formats, chat templates, dataset assembly, generation
  lineage, similarity, evaluation, charset repair).
* ``sources``    readers and writers (whole-text directories, chat-export
  JSON, QA files, per-day files, publish / read back).
* ``streaming``  incremental ingestion with Structured Streaming.
* ``plans``      the registered end-to-end queries over the test tables.
"""

__version__ = "0.1.0"
