"""Exceptions at the API's boundary."""


class CorvaneError(Exception):
    """Base of the corpus builder's errors."""


class DownloadError(CorvaneError): ...


class ArchiveError(CorvaneError): ...


class SourceLayoutError(CorvaneError): ...


class PreprocessingError(CorvaneError): ...


class ShardError(CorvaneError): ...


class PersistenceError(CorvaneError): ...


class DetectionSetupError(CorvaneError): ...


class PairingError(CorvaneError): ...


class QualityError(CorvaneError): ...


class StoreUnavailableError(CorvaneError): ...


class DatasetError(Exception):
    """Base of the reader's errors."""


class ManifestError(DatasetError, ValueError): ...


class DatasetReadError(DatasetError): ...
