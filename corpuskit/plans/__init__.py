"""The registered queries; importing the package registers all of them."""

from corpuskit.plans import catalogue, files, records  # noqa: F401
