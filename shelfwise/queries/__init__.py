"""All registered queries; importing this package fills the registry."""

from shelfwise.queries import catalog, importing, ordering, pricing, repricing, signals, snapshots, web  # noqa: F401
