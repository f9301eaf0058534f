"""packshot: product bundles and their pictures as Spark DataFrames.

``functions``  column expressions (dates, paths, product lists)
``sources``    readers and writers (bundle text, attribute feed, layouts, dated data, images)
``operators``  DataFrame -> DataFrame steps (products, joins, sets, raster tables)
``plans``      whole jobs put together from the operators
"""
