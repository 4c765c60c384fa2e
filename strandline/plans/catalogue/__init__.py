"""The runnable queries over the given tables, each with its SQL twin where one exists."""

from strandline.plans.catalogue import fitted, groups, scalars, storage, tables

MODULES = (storage, scalars, groups, tables, fitted)

QUERIES = {name: entry[0] for module in MODULES for name, entry in module.ENTRIES.items()}
TWINS = {
    name: entry[1]
    for module in MODULES
    for name, entry in module.ENTRIES.items()
    if entry[1] is not None
}
