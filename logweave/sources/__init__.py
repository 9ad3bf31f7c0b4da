from .io import (load_model, load_table, read_delimited, read_documents, read_libsvm,  # noqa: F401
                 read_lines, save_model, save_table, write_partitioned)
