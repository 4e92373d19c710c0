"""airlake: a PySpark library for hourly air-quality feeds.

Layers (all DataFrame functions, Catalyst-planned):

* ``sources``    landing documents (JSON / JSON.gz) -> raw table, weather source, test adapters
* ``functions``  Column expressions: AQI helpers, surrogate keys, feed timestamps
* ``operators``  generic table operators: keep-latest, pivot, explode, pickers, top-k
* ``plans``      the table products (clean, flatten, star schema, rollups), the refresh graph
                 and the parameterised dashboard views
* ``streaming``  incremental file ingest (Structured Streaming, availableNow) and the
                 touched-days refresh
"""

__version__ = "0.1.0"
