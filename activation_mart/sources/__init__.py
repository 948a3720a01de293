from .registry import Sources, activity_type_order
from .snapshot import MasterStore

__all__ = ["MasterStore", "Sources", "activity_type_order"]
