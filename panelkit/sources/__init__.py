from panelkit.sources.files import (  # noqa: F401
    mangle_header,
    read_indicator_folder,
    read_mapping,
    read_sheet,
)
