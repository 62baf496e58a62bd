"""tidewatch — network-flow security analytics as Spark DataFrame operators.

Everything here builds logical plans with the DataFrame / SQL API and lets
Catalyst choose the physical strategy.  Modules:

* ``functions``  column-expression builders (parse, hash, transforms, decode, keys)
* ``operators``  DataFrame -> DataFrame operators (dedup, fit, reports, devices,
                 series, metrics, scoring, training, latest-by-key merge)
* ``sources``    readers (message files, CSV tables, archive, stats, class map)
* ``sinks``      idempotent writers (archive, keyed store, index, CSV export)
* ``plans``      end-to-end compositions that work on batch and streaming frames
* ``streaming``  Structured Streaming jobs (replay, watermark dedup, fan-out, state)
"""

__version__ = "0.1.0"
