"""Review-corpus analytics on Spark DataFrames.

The sub-packages follow the life of a review:

* ``sources``   - CSV, Parquet and saved response pages in; tables out
* ``functions`` - column expressions (cleaning, analysis, labels, ordering)
* ``operators`` - DataFrame to DataFrame steps
* ``plans``     - several operators put together into one job
"""
